"""Vector search: text embedding, exact and approximate nearest neighbours, index upkeep."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import text
from tidewheel.operators import vector_index
from tidewheel.operators.ranking import top_per_key
from tidewheel.operators.topk import Best
from tidewheel.operators.vector_index import DIGITS, list_rows, unit_rows
from tidewheel.sources import changes

QUERY_BATCH = 4096  # queries that may travel inside a task closure (about 2 MB at 64 dimensions)
STEP = 512  # rows of the corpus that are scored against all of them at once


def embed_text(docs: DataFrame, id_column: str, text_column: str, dims: int = 256) -> DataFrame:
    """(id, vector): unit-length TF-IDF vectors over hashed terms."""
    tokens = docs.select(id_column, text.terms(F.col(text_column)).alias("_terms"))
    steps = Pipeline(stages=[
        HashingTF(numFeatures=dims, inputCol="_terms", outputCol="_tf"),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ])
    fitted = steps.fit(tokens).transform(tokens)
    return fitted.select(id_column, vector_to_array("_unit", "float32").alias("vector"))


def top_k_similar(corpus: DataFrame, queries: DataFrame, k: int = 5, query_batch: int = QUERY_BATCH) -> DataFrame:
    """Exact cosine top-k: (query_id, id, score, rank); inputs are (id, vector) / (query_id, vector).

    A batch of up to `query_batch` queries rides along to one scan of the corpus. More queries
    visit the balls of an index, block by block, with the same scores. Filter the corpus before calling.
    """
    asked = vector_index.known(queries, "query_id")
    head = asked.limit(query_batch + 1).collect()
    if len(head) > query_batch:
        return vector_index.exact_top_k(vector_index.build(corpus), asked, k)[0]
    found = _scan(vector_index.known(corpus, "id"), head, k)
    return top_per_key(found, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def _scan(corpus: DataFrame, batch: list, k: int) -> DataFrame:
    """One pass over the corpus; every task reports its own best k per query."""
    schema = "query_id long, id long, score double"
    if not batch:
        return corpus.sparkSession.createDataFrame([], schema)
    query_ids = np.array([r["query_id"] for r in batch])
    matrix = unit_rows([r["vector"] for r in batch])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(query_ids, k)
        for part in batches:
            for at in range(0, part.num_rows, STEP):
                some = part.slice(at, STEP)
                best.add(np.asarray(some.column(0)), np.round(matrix @ unit_rows(list_rows(some.column(1))).T, DIGITS))
        found = best.rows()
        if found is not None:
            yield found

    return corpus.mapInArrow(scan, schema)


def refresh_index(
    index: DataFrame | None, before: DataFrame | None, after: DataFrame, key: str,
    embed: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Index rows for the newest source rows: built when missing, otherwise changed by key.

    Only inserted and updated rows are embedded again.
    """
    if index is None or before is None:
        return embed(after)
    feed = changes.change_feed(before, after, [key])
    changed = embed(feed.where("_change_type <> 'delete'").drop("_change_type"))
    untouched = index.join(feed.select(key), key, "left_anti")
    return untouched.unionByName(changed.select(*index.columns))


def metadata_filter(corpus: DataFrame, condition: Column) -> DataFrame:
    """Metadata condition applied ahead of the ranking."""
    return corpus.where(condition)
