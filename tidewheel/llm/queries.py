"""The registered queries of this package, one for each operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """Where the tokenizer files lie: the installed package of them, or the folder TOKENIZERS."""
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.mixing import mix_to_weights

    return mix_to_weights(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.warc import read_archive, write_archive

    folder = write_archive(table(spark, sf_dir, "pages"))
    # Two scans, each with its record type pushed down: bodies are unpacked for responses alone,
    # whose size and digest come from the payload itself; revisits know both from their headers.
    stored = read_archive(spark, folder).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to",
    )
    again = read_archive(spark, folder).where("record_type = 'revisit'")
    return stored.unionByName(again.select(*stored.columns))


def op4_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.substring_dedup import dedup_substrings

    cut = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op5_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.pieces import decode_documents, encode_documents

    model = tokenizer_path("piece_bpe_32k.model")
    coded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    back = decode_documents(coded.select("row.doc_id", "row.text", "ids"), model)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.token_counts import token_counts

    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op7_token_group_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.jaccard_join import similar_classes

    return similar_classes(table(spark, sf_dir, "documents"), size=3, percent=90)


def op8_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.embedding_tiles import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", F.col("text")), weights).select("row.doc_id", "score")
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.quality_bands import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op11_block_max_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.ranked_search import build_index, search

    index = build_index(table(spark, sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark"), k=20)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.common import materialize
    from tidewheel.llm.conversation_trie import prefix_trie, sequences, with_shared_heads

    own = materialize(sequences(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(materialize(with_shared_heads(own), "rebuilt"))


def op13_elias_fano_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewheel.llm.token_files import token_files

    back = token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end=2)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict[str, Query]:
    found = [
        op1_mixing, op2_sharding, op3_warc, op4_fixed_block_anchors, op5_merge_dropout,
        op6_token_counts, op7_token_group_matrix, op8_int8_tiles,
        op9_toxicity, op10_quality_bands, op11_block_max_maxscore, op12_prefix_trie, op13_elias_fano_ids,
    ]
    return {f.__name__: f for f in found}


#: Terms as the search cuts them: only A to Z change their case.
_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
c AS (SELECT count(*) AS docs, sum(len(t)) AS total FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
q AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS item, * FROM benchmark))
    GROUP BY ALL
),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c
),
s AS (
    SELECT item, item_id, doc_id, CAST(sum(
        times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(t) * docs) // total)))
    ) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), c GROUP BY item, item_id, r, doc_id
),
n AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM n WHERE rank <= 20
"""


#: The unsigned CRC-32 of an id's decimal form, bit by bit.
_CRC = """
(4294967295 - list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END
))
"""
TRIE_SQL = f"""
WITH own AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
h AS (SELECT *, {_CRC} % 9 AS h FROM own),
c AS (
    SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], h.turns[1:0]), h.turns[h.h + 1:]) AS turns
    FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 5
),
p AS (SELECT conv_id, turns, d, turns[1:d] AS prefix FROM c, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)),
n AS (
    SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CASE WHEN len(turns) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends,
        (count(*) - 1) * coalesce(strlen(any_value(prefix[d].t)), 0) AS saved
    FROM p GROUP BY prefix, d
),
k AS (
    SELECT n.prefix, n.d, count(*) AS n_children FROM n JOIN n c ON c.d = n.d + 1 AND c.prefix[1:n.d] = n.prefix
    GROUP BY ALL
),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.prefix = n.prefix),
s AS (
    SELECT prefix[1:a] AS prefix, a AS d, sum(saved) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM m) GROUP BY ALL
)
SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children,
    CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s ON s.d = m.d AND s.prefix = m.prefix LEFT JOIN m u ON u.d = m.d - 1 AND u.prefix = m.prefix[1:m.d - 1]
"""


#: Of equal payloads of 100 bytes or more the smallest page is the response.
ARCHIVE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
r AS (SELECT *, strlen(payload) >= 100 AND page_id <> first_id AS again FROM f)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to
FROM r
"""


#: Words are joined by spaces, which they cannot hold, so equal strings are equal sequences.
REPEATS_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
    SELECT r, p, sha256(array_to_string(w[p:p + 34], ' ')) AS h
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d)
),
hits AS (SELECT r, p FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(p, p + 35)) AS p FROM hits)),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


#: Rows linked by a pair, and from each row all it reaches.
_REACHED = """
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (SELECT r AS a, r AS b FROM d UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b)
"""
SHINGLES_SQL = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
    ) AS w FROM documents
),
g AS (
    SELECT DISTINCT r, array_to_string(w[p:p + 2], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS p FROM d)
),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
met AS (SELECT x.r AS a, y.r AS b, count(*) AS n_both FROM g x JOIN g y ON x.g = y.g AND x.r < y.r GROUP BY ALL),
pairs AS (SELECT a, b FROM met JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
{_REACHED}
SELECT any_value(d.doc_id) AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM reached JOIN d ON d.r = a JOIN d o ON o.r = b LEFT JOIN n ON n.r = a GROUP BY a
"""


VECTORS_SQL = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
u AS MATERIALIZED (
    SELECT * FROM d WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0
),
pairs AS (
    SELECT x.r AS a, y.r AS b FROM u x JOIN u y ON x.label = y.label AND x.r < y.r AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.98
),
{_REACHED},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT any_value(d.vec_id) AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(o.vec_id) AS component_id,
    any_value(d.vec_id) = min(o.vec_id) AS kept
FROM reached JOIN d ON d.r = reached.a JOIN d o ON o.r = reached.b LEFT JOIN n ON n.a = reached.a GROUP BY reached.a
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": ARCHIVE_SQL, "op4_fixed_block_anchors": REPEATS_SQL, "op7_token_group_matrix": SHINGLES_SQL,
        "op8_int8_tiles": VECTORS_SQL, "op11_block_max_maxscore": SEARCH_SQL, "op12_prefix_trie": TRIE_SQL,
    }
