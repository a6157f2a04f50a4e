"""Exact top-k by inner product through global score histograms.

Queries come in blocks of bounded size, each block broadcast and scored against
every row. For each query an interval holds the kth highest score; one pass
counts all scores in equal bins of the interval, the bin that holds the kth
becomes the next interval, until it is a single score. A last pass keeps what
reaches that score and settles ties by id.

A pass sends little: a task's own kth highest score is a lower bound of the
global one, so it counts only bins from there up, k at most for each query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import each_batch, staged

# Queries that are scored together; their vectors are broadcast.
QUERY_BLOCK = 2_048
# Bytes of queries that are broadcast: a block holds fewer of wider vectors.
QUERY_BLOCK_BYTES = 4 << 20
BINS = 4_096
# Scores that a task holds at once.
SCORES_AT_ONCE = 1 << 20
EXACT = 1 << 53


def whole_vectors(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """vec_id and vector (array<bigint>), each component floor(scale * x).

    Rows with a null id, a null vector, or a null or non-finite component are
    left out, and so are components beyond 64 bits.
    """
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(scale)))
    big = F.lit(float(1 << 62))
    sound = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * F.lit(scale)) < big),
    )
    return rows.filter(
        F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & sound
    ).select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("vector"))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and their values, for each vector length that occurs."""
    ends = column.offsets.to_numpy()
    lengths = np.diff(ends)
    values = column.values.to_numpy(zero_copy_only=False)
    out = []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        out.append((at, values[ends[at][:, None] + np.arange(length)].astype(np.int64)))
    return out


class Scorer:
    """Scores of one block of queries, exact in whole numbers."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        self.ids = ids
        self.groups = {}
        lengths = np.array([len(v) for v in vectors])
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            values = np.stack([vectors[i] for i in at]) if length else np.zeros((len(at), 0), np.int64)
            self.groups[int(length)] = (at, values)

    def scores(self, batch: pa.RecordBatch):
        """(query rows, ids of the candidates, scores as whole numbers, mask of
        a query's own row) for pieces of the batch."""
        ids = batch.column("vec_id").to_numpy()
        for at, rows in _matrix(batch.column("vector")):
            if rows.shape[1] not in self.groups:
                continue
            queries, asked = self.groups[rows.shape[1]]
            bound = float(np.abs(rows).max(initial=0)) * float(np.abs(asked).max(initial=0))
            floats = bound * max(1, rows.shape[1]) < EXACT
            kind = np.float64 if floats else np.int64
            left, right = asked.astype(kind), rows.astype(kind).T
            step = max(1, SCORES_AT_ONCE // len(queries))
            for i in range(0, len(at), step):
                found = (left @ right[:, i : i + step]).astype(np.int64)
                took = ids[at[i : i + step]]
                yield queries, took, found, self.ids[queries][:, None] == took[None, :]


LOWEST = np.iinfo(np.int64).min


def _histograms(
    scorer: Scorer, low: np.ndarray, high: np.ndarray, width: np.ndarray, need: np.ndarray
):
    """Counts of the scores from ``low`` to below ``high`` by bin, 0 the lowest."""

    def work(batches):
        counts = np.zeros((len(scorer.ids), BINS), dtype=np.int64)
        for batch in batches:
            for queries, _, found, own in scorer.scores(batch):
                lo, hi, wide = (x[queries][:, None] for x in (low, high, width))
                inside = (found >= lo) & (found < hi) & ~own
                flat = (queries[:, None] * BINS + (found - lo) // wide)[inside]
                counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        rows, bins = np.nonzero((counts > 0) & (above < need[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(bins), pa.array(counts[rows, bins])], ["q", "bin", "n"]
        )

    return work


def _spread(scorer: Scorer):
    """Lowest and highest score, and how many there are, for each query."""

    def work(batches):
        least = np.full(len(scorer.ids), np.iinfo(np.int64).max)
        most = np.full(len(scorer.ids), LOWEST)
        n = np.zeros(len(scorer.ids), dtype=np.int64)
        for batch in batches:
            for queries, _, found, own in scorer.scores(batch):
                least[queries] = np.minimum(least[queries], np.where(own, least[queries][:, None], found).min(1))
                most[queries] = np.maximum(most[queries], np.where(own, most[queries][:, None], found).max(1))
                n[queries] += (~own).sum(1)
        q = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(least[q]), pa.array(most[q]), pa.array(n[q])], ["q", "least", "most", "n"]
        )

    return work


def _reaching(scorer: Scorer, kth: np.ndarray, k: int):
    """Rows that reach the kth score; of a task's ties only the k smallest ids
    of each query, as no more can be taken."""

    def work(batch: pa.RecordBatch):
        parts = []
        for queries, ids, found, own in scorer.scores(batch):
            r, c = np.nonzero((found >= kth[queries][:, None]) & ~own)
            parts.append(pd.DataFrame({"q": queries[r], "vec_id": ids[c], "score": found[r, c]}))
        if not parts:
            return []
        kept = pd.concat(parts).sort_values(["q", "score", "vec_id"], ascending=[True, False, True])
        kept = kept.groupby("q").head(k)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(scorer.ids[kept.q.to_numpy(dtype=np.int64)], pa.int64()),
                pa.array(kept.vec_id.to_numpy(dtype=np.int64)),
                pa.array(kept.score.to_numpy(dtype=np.int64)),
            ],
            ["query_id", "vec_id", "score"],
        )

    return each_batch(work)


def _block(vectors: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """The k best rows (and ties within a task) of one block of queries."""
    n = len(scorer.ids)
    ends = vectors.mapInArrow(_spread(scorer), "q long, least long, most long, n long")
    ends = ends.groupBy("q").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"))
    low, high = np.full(n, LOWEST), np.full(n, LOWEST)
    width, need = np.ones(n, np.int64), np.zeros(n, np.int64)
    open_ = np.zeros(n, dtype=bool)
    for row in ends.collect():  # one row for each query of the block
        low[row.q] = row.least
        if row.n > k:
            need[row.q], open_[row.q], high[row.q] = k, True, row.most + 1
            width[row.q] = (row.most - row.least) // BINS + 1
    while open_.any():
        # Queries that are settled look for nothing: no bin is above a need of 0.
        wanted = np.where(open_, need, 0)
        seen = vectors.mapInArrow(
            _histograms(scorer, low, high, width, wanted), "q long, bin long, n long"
        )
        seen = seen.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        over = Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        # The bin that holds the kth score: one row for each query of the block.
        asked = F.element_at(F.lit([int(x) for x in need]), (F.col("q") + 1).cast("int"))
        held = (
            seen.withColumn("above", F.coalesce(F.sum("n").over(over), F.lit(0)))
            .filter((F.col("above") < asked) & (F.col("above") + F.col("n") >= asked))
            .collect()
        )
        for row in held:
            low[row.q] += row.bin * width[row.q]
            high[row.q] = min(high[row.q], low[row.q] + width[row.q])
            need[row.q] -= row.above
            open_[row.q] = width[row.q] > 1
            width[row.q] = (width[row.q] - 1) // BINS + 1
    found = vectors.mapInArrow(_reaching(scorer, low, k), "query_id long, vec_id long, score long")
    return staged(found, "reaching")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k highest inner products of every query row against all other rows.

    ``vectors`` has vec_id and vector (see ``whole_vectors``); rows with the
    query's own vec_id are no candidates of it. Vectors of another length than
    the query's are not compared with it. Ties go to the smaller vec_id; a
    candidate that occurs twice counts twice. Of several query rows with one
    vec_id the smallest vector asks. A query without candidates has no rows.
    Scores are exact within 64 bits. Returns query_id, rank (from 1), vec_id,
    score.
    """
    spark = vectors.sparkSession
    asking = vectors.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asking = staged(asking, "queries")
    size = asking.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    per_block = max(1, min(query_block, QUERY_BLOCK_BYTES // (8 * max(1, size[1] or 1))))
    blocks = -(-size[0] // per_block)
    out, start = None, None
    for _ in range(blocks):
        rest = asking if start is None else asking.filter(F.col("vec_id") > start)
        block = rest.orderBy("vec_id").limit(per_block).collect()  # per_block rows at most
        start = block[-1].vec_id
        scorer = Scorer(
            np.array([r.vec_id for r in block], np.int64), [np.array(r.vector, np.int64) for r in block]
        )
        found = _block(vectors, scorer, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        out.withColumn("rank", ranked.cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
