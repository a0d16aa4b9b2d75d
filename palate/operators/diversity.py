"""Maximal marginal relevance: trade score against likeness to what is already listed."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.operators.ranking import rounded, top_k_per

LAMBDA = 0.7
POOL = 100
#: Candidate scores have six decimals; lambda times such a number may end half-way there.
MMR_DIGITS = 9


SCHEMA = pa.schema(
    [("queryId", pa.int64()), ("movieId", pa.int64()), ("score", pa.float64()), ("mmr", pa.float64()), ("rank", pa.int32())]
)


def _vectors(lists: pa.ListArray) -> np.ndarray:
    """Unit rows; a null or zero vector is a row of zeros."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    m = np.zeros((len(lists), sizes.max(initial=1)))
    m[sizes > 0] = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, m.shape[1])
    lengths = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(lengths == 0.0, 1.0, lengths)


def _picks(relevance: np.ndarray, m: np.ndarray, lam: float, k: int) -> tuple[list[int], list[float]]:
    """Rows in the order in which they are picked, and their values.  Ties go to the earlier row."""
    closest = np.zeros(len(relevance))
    open_ = np.ones(len(relevance), dtype=bool)
    picked, values = [], []
    for _ in range(min(k, len(relevance))):
        value = np.round(lam * relevance - (1.0 - lam) * closest, MMR_DIGITS)
        best = int(np.argmax(np.where(open_, value, -np.inf)))
        likeness = m @ m[best]
        closest = np.maximum(closest, likeness) if picked else likeness
        picked.append(best)
        values.append(value[best])
        open_[best] = False
    return picked, values


def _queries(table: pa.Table) -> np.ndarray:
    """Query ids in ascending order; a null id sorts first and is a query like any other."""
    return pc.fill_null(table["queryId"], -(2**63)).to_numpy()


def _rerank(table: pa.Table, lam: float, k: int) -> pa.Table:
    """The lists of whole queries; rows come in order of query and item."""
    table = table.combine_chunks()
    query = _queries(table)
    relevance, m = table["score"].to_numpy(), _vectors(table["features"].combine_chunks())
    starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    rows, values, ranks = [], [], []
    for a, b in zip(starts, [*starts[1:], len(query)], strict=True):
        picked, mmr = _picks(relevance[a:b], m[a:b], lam, k)
        rows += [a + i for i in picked]
        values += mmr
        ranks += range(1, len(picked) + 1)
    chosen = table.select(["queryId", "movieId", "score"]).take(pa.array(rows, pa.int64()))
    return pa.Table.from_arrays([*chosen.columns, pa.array(values, pa.float64()), pa.array(ranks, pa.int32())], schema=SCHEMA)


def _greedy(lam: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches cut queries anywhere: a batch's last query waits for the next batch."""
        waiting: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            query = _queries(table)
            whole = int(np.searchsorted(query, query[-1]))
            if whole:
                yield from _rerank(table.slice(0, whole), lam, k).to_batches()
            waiting = table.slice(whole)
        if waiting is not None:
            yield from _rerank(waiting, lam, k).to_batches()

    return run


def mmr_rerank(
    candidates: DataFrame, vectors: DataFrame, lam: float = LAMBDA, k: int = 10, pool: int = POOL
) -> DataFrame:
    """``queryId, movieId, score, mmr, rank`` from ``queryId, movieId, score``.

    Picks ``argmax lam·score - (1-lam)·max cosine to the picked`` over each query's ``pool`` best
    candidates; ``vectors`` is ``id, features`` and an item without one is unlike everything.
    The selection is sequential per query; queries are dealt to tasks and sorted there, and a batch
    holds the shortlists of many.
    """
    order = [F.desc("score"), F.asc("movieId")]
    shortlist = candidates.select(
        F.col("queryId").cast("bigint").alias("queryId"),
        F.col("movieId").cast("bigint").alias("movieId"),
        rounded(F.col("score").cast("double")).alias("score"),
    )
    shortlist = top_k_per(shortlist, "queryId", order, pool).drop("rank")
    known = vectors.select(F.col("id").cast("bigint").alias("movieId"), "features")
    sorted_ = shortlist.join(known, "movieId", "left").repartition("queryId").sortWithinPartitions("queryId", "movieId")
    return sorted_.select("queryId", "movieId", "score", "features").mapInArrow(
        _greedy(lam, k), "queryId bigint, movieId bigint, score double, mmr double, rank int"
    )
