"""Ranking, sampling, search, traces, sessions, training and synthesis against brute force."""

import math
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.operators import (
    bookings, chunks, evaluation, lexical, ranking, sampling, sessions, synthesis, tracking, traces, training, usage, vectors,
)
from tidewheel.plans import inputs


# --- ranking and sampling ---


def test_positions_by_hash_is_a_permutation(spark):
    placed = ranking.positions_by_hash(spark.range(5000), F.col("id"))
    row = placed.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()
    assert tuple(row) == (1, 5000, 5000)


@pytest.mark.parametrize("order", ["t % 997", "t", "CASE WHEN t < 3000 THEN 5 ELSE t END"])
def test_positions_of_a_hot_key(spark, order):
    """A key with most rows, also when one order value holds most of them, ranks like a window."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 6 == 0, "cold").otherwise("hot").alias("k"), F.col("id").alias("t")
    ).select("k", F.expr(order).cast("long").alias("o"), F.col("t").alias("tie"))
    ranked = ranking.positions_by_key(rows, ["k"], "o", "tie", previous="before")
    whole = Window.partitionBy("k").orderBy("o", "tie")
    expected = rows.withColumns({"position": F.row_number().over(whole).cast("long"), "before": F.lag("o").over(whole)})
    columns = ["k", "o", "tie", "position", "before"]
    assert ranked.count() == 6000
    assert ranked.select(columns).exceptAll(expected.select(columns)).count() == 0


def test_sample_share(spark):
    rows = spark.range(995)
    first = {r.id for r in sampling.sample_share(rows, F.col("id"), 10).collect()}
    assert len(first) == 99 and first == {r.id for r in sampling.sample_share(rows, F.col("id"), 10).collect()}
    assert sampling.sample_share(spark.range(3), F.col("id"), 10).count() == 1
    assert sampling.sample_share(spark.range(0), F.col("id"), 10).count() == 0


def test_resample(spark):
    drawn = sampling.resample(spark.range(50), F.col("id"), 400, seed=3)
    assert drawn.count() == 400 and drawn.columns == ["id"]
    assert drawn.distinct().count() <= 50
    assert sampling.resample(spark.range(0), F.col("id"), 10, seed=3).count() == 0


# --- search ---


def vector_frames(spark, n=400, queries=30, copies=0):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(n, 8))
    matrix[:copies] = matrix[0]
    asked = rng.normal(size=(queries, 8))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "id long, vector array<float>")
    wanted = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, vector array<float>")
    return matrix.astype(np.float32), asked.astype(np.float32), corpus, wanted


def brute(matrix, asked, k):
    def unit(m):
        return m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)

    scores = np.round(unit(asked) @ unit(matrix).T, 6)
    return {
        (q, int(i), r + 1) for q, row in enumerate(scores) for r, i in enumerate(np.lexsort((np.arange(len(row)), -row))[:k])
    }


@pytest.mark.parametrize("copies", [0, 150])
@pytest.mark.parametrize("batch", [4096, 0])
def test_nearest_neighbours(spark, copies, batch):
    """Both ways agree with brute force, also when a group of copies holds a third of the rows."""
    matrix, asked, corpus, wanted = vector_frames(spark, copies=copies)
    found = vectors.top_k_similar(corpus, wanted, 5, query_batch=batch).collect()
    assert {(r.query_id, r.id, r["rank"]) for r in found} == brute(matrix, asked, 5)


def test_bm25_both_ways(spark):
    texts = ["red fox runs", "the red red dog", "a blue fox", "nothing here", "", "fox fox fox red"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    queries = spark.createDataFrame([(1, "red fox"), (2, "missing words"), (3, "Blue!")], "query_id long, text string")
    tokens = [re.findall(r"\w+", t.lower()) for t in texts]
    mean, expected = sum(map(len, tokens)) / len(tokens), set()
    for q, words in ((1, ["red", "fox"]), (2, ["missing", "words"]), (3, ["blue"])):
        scored = []
        for i, t in enumerate(tokens):
            count = Counter(t)
            s = 0.0
            for w in words:
                df = sum(w in u for u in tokens)
                if count[w]:
                    s += math.log(1 + (len(tokens) - df + 0.5) / (df + 0.5)) * count[w] * 2.2 / (count[w] + 1.2 * (0.25 + 0.75 * len(t) / mean))
            if s > 0:
                scored.append((-round(s, 6), i))
        expected |= {(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(scored)[:3])}
    for limit in (20_000, 0):
        found = lexical.bm25(docs, queries, 3, scan_terms=limit).collect()
        assert {(r.query_id, r.id, r.score, r["rank"]) for r in found} == expected


def test_bm25_null_texts_and_string_ids_both_ways(spark):
    texts = ["red fox", None, "the red dog runs", None, "blue"]
    queries = spark.createDataFrame([(1, "red fox")], "query_id int, text string")
    for kind, name in (("int", int), ("string", lambda i: f"d{i}")):
        docs = spark.createDataFrame([(name(i), t) for i, t in enumerate(texts)], f"id {kind}, text string")
        scan, join = (lexical.bm25(docs, queries, 3, scan_terms=n) for n in (20_000, 0))
        assert scan.schema["id"].dataType == join.schema["id"].dataType
        assert sorted(scan.collect()) == sorted(join.collect())
        idf = math.log(1 + 3.5 / 2.5) + math.log(1 + 4.5 / 1.5)  # five documents, a mean of 7 / 3 terms
        assert max(r.score for r in scan.collect()) == round(idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / (7 / 3))), 6)


def test_fusion_and_rerank(spark):
    ranked = "query_id long, id long, rank int"
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], ranked)
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], ranked)
    fused = lexical.fuse(a, b, 3).collect()
    assert [(r.id, r["rank"]) for r in sorted(fused, key=lambda r: r["rank"])] == [(11, 1), (10, 2), (12, 3)]
    docs = spark.createDataFrame([(10, "red fox", "fox", None), (11, "blue", "", ""), (12, "", "red fox", "red fox")], "id long, text string, title string, summary string")
    queries = spark.createDataFrame([(1, "red fox")], "query_id long, text string")
    best = lexical.rerank(lexical.fuse(a, b, 3), queries, docs, 3).collect()
    assert [(r.id, r.score) for r in sorted(best, key=lambda r: r["rank"])] == [(10, 0.75), (12, 0.4), (11, 0.0)]


def test_embedding_is_unit_length(spark):
    docs = spark.createDataFrame([(1, "red fox"), (2, "blue dog runs")], "id long, text string")
    for r in vectors.embed_text(docs, "id", "text", 64).collect():
        assert np.linalg.norm(r.vector) == pytest.approx(1.0, abs=1e-5)


def test_index_is_built_then_refreshed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "id int, text string")
    seen = []

    def embed(df):
        seen.append(df.count())
        return df.select("id", F.upper("text").alias("vector"))

    index = vectors.refresh_index(None, None, old, "id", embed)
    fresh = vectors.refresh_index(index, old, new, "id", embed)
    assert sorted(map(tuple, fresh.collect())) == [(2, "B"), (3, "C")] and seen == [2, 2]


# --- chunks, traces, evaluation ---


def test_chunk_edge_cases(spark):
    parsed = spark.createDataFrame([
        ("/v/p1.pdf", '{"document": {"elements": [{"type": "text", "content": "docu-\\nments  here"}, {"id": "2", "type": "table", "content": "x"}, {"id": "3", "type": "text", "content": null}]}}', 1),
        ("/v/p2.pdf", '{"document": {"elements": []}}', 1), ("/v/p3.pdf", '{"other": 1}', 1), ("/v/p4.pdf", "no json", 2),
    ], "path string, parsed_content string, processed long")
    papers = spark.createDataFrame([("p1", "T", "S", ["A", "B"], 202403040506)], "paper_id string, title string, summary string, authors array<string>, published long")
    rows = chunks.chunk_table(parsed, papers, 1).collect()
    assert sorted((r.chunk_id, r.text, r.id) for r in rows if r.text) == [("", "documents here", "p1_")]
    assert [r.text for r in rows if r.chunk_id == "3"] == [None]
    assert (rows[0].authors, rows[0].year, rows[0].month, rows[0].day) == ("A, B", 2024, 3, 4)


def test_rollup_without_spans(spark, sf_dir):
    log = inputs.trace_log(spark, sf_dir)
    dropped = traces.rollup(log, assessed_only=False)
    kept = traces.rollup(log, assessed_only=False, keep_empty=True)
    assert kept.count() == log.count() > dropped.count() == log.where(F.size("spans") > 0).count()
    assert "processed_ts" in kept.columns
    assert kept.where("call_llm_exec_count + tool_call_count = 0").agg(F.max("total_tokens_used")).first()[0] == 0
    one = traces.rollup(log, endpoint="click", assessed_only=False)
    assert one.count() == dropped.join(log.where("tags['model_serving_endpoint_name'] = 'click'"), "trace_id", "left_semi").count()
    assert traces.span_rows(log, outer=True).count() > traces.span_rows(log).count()


def test_agreement(spark):
    rows = spark.createDataFrame([(1, 1)] * 4 + [(0, 0)] * 3 + [(1, 0)] * 2 + [(0, 1), (None, 1)], "judge int, human int")
    r = evaluation.agreement(rows).first()
    assert (r.n, r.both_pass, r.judge_only, r.human_only, r.both_fail) == (10, 4, 2, 1, 3)
    chance = (6 * 5 + 4 * 5) / 100
    assert r.kappa == pytest.approx((0.7 - chance) / (1 - chance))
    assert evaluation.agreement(rows.where("judge = 1 AND human = 1")).first().kappa is None


def test_scores_written_back_by_key(spark):
    feedback = spark.createDataFrame([("t1", "word_count_check", "false"), ("t1", "polite_tone", "Pass")], "trace_id string, name string, value string")
    answers = spark.createDataFrame([("t2", "b"), ("t1", "a")], "trace_id string, text string")
    merged = evaluation.write_back(feedback, evaluation.score(answers, "trace_id", "text"))
    assert sorted(map(tuple, merged.collect())) == [
        ("t1", "polite_tone", "Pass"), ("t1", "word_count_check", "true"), ("t2", "word_count_check", "true"),
    ]


# --- sessions, tracking, usage ---


def test_history_breaks_ties_by_id(spark):
    t = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(2, "s", '{"role": "assistant", "content": "b"}', t), (1, "s", '{"role": "user", "content": "a"}', t)], "id long, session_id string, message_data string, created_at timestamp_ntz")
    assert [(r.position, r.content) for r in sessions.history(rows).orderBy("position").collect()] == [(1, "a"), (2, "b")]
    assert sessions.history(rows, "other").count() == 0
    assert [r.content for r in sessions.last_messages(rows, 1).collect()] == ["b"]


def test_tracking_ties_and_tags(spark):
    metrics = spark.createDataFrame([(1, "rmse", 1, 9.0), (1, "rmse", 2, 5.0), (1, "rmse", 2, 7.0)], "run_id int, key string, step int, value double")
    r = tracking.last_metric(metrics).first()
    assert (r.last_value, r.best_value, r.max_step, r.n_points) == (7.0, 5.0, 2, 3)


def test_cost_without_totals(spark):
    rows = spark.createDataFrame([("P", "S_US_EAST", "u", 1.0), ("P", "S_EU_WEST", "u", 2.0)], "billing_origin_product string, sku_name string, usage_unit string, usage_quantity double")
    assert [tuple(r) for r in usage.cost_rollup(rows, totals=False).collect()] == [("P", "S", "u", 3.0, 2)]


# --- training and synthesis ---


def training_rows(spark):
    return spark.range(240).select(
        *[(F.col("id") % (i + 2)).cast("int").alias(c) for i, c in enumerate(bookings.NUMERIC[:-1])],
        (F.col("id") % 24).cast("int").alias("lead_time"),
        F.concat(F.lit("Meal "), F.col("id") % 3).alias("type_of_meal"), F.lit("Room_Type_1").alias("room_type"),
        (F.col("id") % 12 + 1).cast("int").alias("arrival_month"), F.lit("Online").alias("market_segment_type"),
        (80.0 + F.col("id") % 24).alias("average_price"), F.concat(F.lit("INN"), "id").alias("Booking_ID"),
    )


def test_training_learns_and_gate_decides(spark):
    rows = training_rows(spark)
    frame = training.feature_frame(rows, bookings.category_codes(rows, bookings.CATEGORICAL)).cache()
    weak, strong = training.train(frame, {"n_estimators": 1}), training.train(frame, {"n_estimators": 15, "learning_rate": 0.3})
    old, new = training.metrics(weak, frame), training.metrics(strong, frame)
    assert training.promotion(old, new).first().register is True
    assert training.promotion(new, old).first().register is False
    assert training.promotion(new, new).first().register is False
    assert training.promotion(None, new).first().register is True
    unseen = rows.withColumn("room_type", F.lit("Room_Type_999")).limit(5)
    coded = training.feature_frame(unseen, bookings.category_codes(rows, bookings.CATEGORICAL))
    assert training.score(strong, coded).where("prediction IS NOT NULL").count() == 5


def test_trials_stay_inside_the_space():
    for t in training.random_trials(trials=50):
        assert 50 <= t["n_estimators"] <= 700 and t["n_estimators"] % 50 == 0
        assert 0.01 <= t["learning_rate"] <= 0.2 and t["max_depth"] in (3, 5, 10, 15)
    assert training.random_trials() == training.random_trials()


def test_ab_scoring(spark):
    rows = spark.createDataFrame([(f"INN{i}",) for i in range(40)], "Booking_ID string")
    models = {"A": lambda d: d.withColumn("prediction", F.lit(100.0)), "B": lambda d: d.withColumn("prediction", F.lit(200.0))}
    scored = training.ab_score(rows, "Booking_ID", models)
    assert scored.count() == 40
    assert {(r.variant, r.price) for r in scored.collect()} == {("A", 105.0), ("B", 210.0)}


def test_synthetic_rows(spark, sf_dir):
    rows = inputs.bookings(spark, sf_dir)
    model = synthesis.fit(rows, ["lead_time", "average_price"], ["market_segment_type"])
    newest = bookings.newest_date(rows)
    out = synthesis.next_month_rows(spark, model, newest, 3000, ["lead_time"])
    assert out.count() == 3000
    months = out.select(F.trunc("date_of_reservation", "MM")).distinct().collect()
    assert len(months) == 1 and months[0][0] > newest.replace(day=1)
    assert out.where("arrival_date < date_of_reservation").count() == 0
    real, made = (d.agg(F.avg("lead_time"), F.avg("average_price"), F.min("lead_time"), F.max("lead_time")).first() for d in (rows, out))
    assert made[0] == pytest.approx(real[0], rel=0.1) and made[1] == pytest.approx(real[1], rel=0.15)
    assert made[2] >= real[2] and made[3] <= real[3]
    assert {r[0] for r in out.select("market_segment_type").distinct().collect()} <= {r[0] for r in rows.select("market_segment_type").distinct().collect()}


def test_synthesis_keeps_correlation(spark):
    rows = spark.range(4000).select(F.randn(1).alias("x"), F.randn(2).alias("e")).select("x", (F.col("x") * 2 + F.col("e")).alias("y"))
    model = synthesis.fit(rows, ["x", "y"], [])
    assert synthesis.sample(spark, model, 4000).corr("x", "y") == pytest.approx(rows.corr("x", "y"), abs=0.06)


def test_registered_training_is_the_whole_job(spark, sf_dir, monkeypatch):
    from tidewheel.operators import training
    from tidewheel.plans import training_queries

    fitted, tuned = [], []
    monkeypatch.setattr(training, "train", lambda frame, parameters=None: fitted.append((frame.count(), parameters)))
    monkeypatch.setattr(training, "tune", lambda frame, later, trials: tuned.extend(trials))
    for name in ("score", "metrics", "promotion"):
        monkeypatch.setattr(training, name, lambda *_: None)
    training_queries.gbt_scores(spark, sf_dir)
    training_queries.promotion_gate(spark, sf_dir)
    training_queries.hpo_trials(spark, sf_dir)
    (whole, _), (champion, _), (challenger, _) = fitted
    assert [p for _, p in fitted] == [None] * 3 and 0 < champion < challenger == whole
    assert tuned == training.random_trials() and max(t["n_estimators"] for t in tuned) > 500
