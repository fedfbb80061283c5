"""Texts of the pipeline meet small tables where they are: no join shuffles them, whatever Spark would broadcast by itself."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("tidewheel.llm")
import corpus_pipeline  # noqa: E402
from tidewheel.llm import mixing  # noqa: E402
from tidewheel.llm.common import row_marks, where_marked  # noqa: E402


@pytest.fixture
def docs(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*words[i % 4 :], f"t{i // 2}"]), "ab"[i % 2]) for i in range(24)]
    yield spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def last_join(df, capsys):
    """The first line of the plan, from the result down, that names a join or a shuffle."""
    df.explain()
    lines = capsys.readouterr().out.splitlines()
    return next(x for x in lines if "Join" in x or "Exchange" in x)


def test_rows_kept_by_near_duplicates_and_mix_are_not_shuffled(spark, docs, capsys):
    for out in (corpus_pipeline.one_of_each(spark, docs, ""), mixing.mixed_documents(docs.coalesce(2), copy="mix_copy")):
        assert "BroadcastHashJoin" in last_join(out, capsys)
        assert out.count()


def test_few_and_many_cuts_mix_alike(docs, monkeypatch):
    few = mixing.mixed_documents(docs, copy="mix_copy").collect()
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(mixing.mixed_documents(docs, copy="mix_copy").collect()) == sorted(few)


def test_marks_are_exact(spark):
    rows = spark.range(70_000, numPartitions=2).withColumn("n", F.monotonically_increasing_id())
    wanted = rows.where("id % 3 = 1 OR id IN (0, 32767, 32768, 34999, 35000, 69999)")
    found = where_marked(rows, "n", row_marks(wanted, "n"))
    assert found.exceptAll(wanted).isEmpty() and found.count() == wanted.count()
