"""Running top-k inside a task, shared by vector and lexical scans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def keep_best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best (score descending, id ascending); only what may be among them is sorted."""
    width = scores.shape[1]
    if width > 4 * k:
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        ties = int((scores >= kth[:, None]).sum(axis=1).max())
        if ties < width:
            some = np.argpartition(-scores, ties - 1, axis=1)[:, :ties]
            ids, scores = np.take_along_axis(ids, some, 1), np.take_along_axis(scores, some, 1)
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


class Best:
    """The k best documents per query seen so far by this task."""

    def __init__(self, query_ids: np.ndarray, k: int) -> None:
        self.query_ids, self.k = query_ids, k
        self.ids = self.scores = None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of some documents, one row per query; minus infinity means no match."""
        ids = np.broadcast_to(ids, scores.shape)
        if self.ids is not None:
            ids, scores = np.hstack([self.ids, ids]), np.hstack([self.scores, scores])
        self.ids, self.scores = keep_best(ids, scores, self.k)

    def rows(self) -> pa.RecordBatch | None:
        """(query_id, id, score) of what is left."""
        if self.ids is None:
            return None
        found = np.isfinite(self.scores)
        columns = [np.repeat(self.query_ids, self.ids.shape[1])[found.ravel()], self.ids[found], self.scores[found]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "score"])
