"""Exact top-k search by distributed histogram selection.

Each component x counts as floor(256 * x); the score of a query and a candidate is the integer inner product.
Queries are taken in blocks of fixed size, and each block is broadcast. For a block, every task scores all of
its vectors. Rounds of histograms then close in on the k-th best score of each query: a round divides the
interval that holds it into ``BINS`` bins, adds up the counts of all tasks, and keeps the bin in which the
count from the top reaches k, until bins are single scores. A task reports only bins at or above its own k-th
best score, since the global one can't be lower; so it sends at most k bins a query. The last pass keeps the
candidates at or above the k-th score, and of those tied there the k with the smallest ids; the rest of a
tie, however large, never leaves its task.

Vectors that are null, empty or hold a null or non-finite component take no part, and neither do rows without
an id. A query meets only candidates of its own length. A candidate with the query's id is the query's own
row; candidates that share an id are separate candidates. A query id that occurs in several rows is a query
for each of its different vectors, and their results are merged under the id, best first. Queries with fewer
than k candidates return all of them. Scores beyond 64 bits raise OverflowError. Only the two named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches
from mercatura.session import stage

SCALE = 256
#: Queries that are broadcast at once, and bins of a histogram.
QUERY_BLOCK, BINS = 4096, 1024
#: Below this bound every partial sum is an exact double.
EXACT = 1 << 52
#: Scores that a task holds at a time.
TILE = 1 << 21


def _usable(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, number), F.lit(False))


def scaled(vectors: list[np.ndarray]) -> np.ndarray:
    """floor(256 x) as whole doubles; 256 x of a finite float is exact, of a huge double it may overflow."""
    with np.errstate(over="raise"):
        try:
            return np.floor(SCALE * np.stack(vectors).astype(np.float64))
        except FloatingPointError:
            raise OverflowError("a component is too large for integer scores") from None


def inner(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products, queries by rows."""
    top = lambda m: float(np.abs(m).max(initial=0))
    if top(queries) * top(candidates) * queries.shape[1] < EXACT:
        return (queries @ candidates.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
    return (whole(queries) @ whole(candidates).T).astype(np.int64)


def _tiles(batches: Iterator[pa.RecordBatch], blocks: dict) -> Iterator[tuple]:
    """(query ids, candidate ids, scores, and where the candidate is the query's own row) by tile."""
    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
        column = batch.column("vector")
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.diff(column.offsets.to_numpy())
        starts = np.cumsum(sizes) - sizes
        for size, (query_ids, queries) in blocks.items():
            rows = np.flatnonzero(sizes == size)
            step = max(1, TILE // len(query_ids))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                vectors = scaled([flat[starts[r] : starts[r] + size] for r in some])
                yield query_ids, ids[some], inner(queries, vectors), size


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k best scores of each row, unordered."""
    return scores if scores.shape[1] <= k else np.partition(scores, -k, axis=1)[:, -k:]


def _histograms(blocks: dict, lows: dict, highs: dict, k: int):
    """Counts by query and bin of the interval, from each task's bins at or above its k-th best score.

    ``lows`` and ``highs`` hold the interval of each query; scores above it count in the bin ``BINS``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for query_ids, ids, scores, size in _tiles(batches, blocks):
            scores = np.where(query_ids[:, None] == ids[None, :], np.iinfo(np.int64).min, scores)
            held = best.get(size)
            joined = scores if held is None else np.concatenate((held, scores), axis=1)
            best[size] = _best(joined, k)
        for size, top in best.items():
            low, high = lows[size][:, None], highs[size][:, None]
            width = np.maximum(1, -(-(high - low) // BINS))
            bins = np.minimum((top - low) // width, BINS)
            row, col = np.nonzero((top >= low) & (top > np.iinfo(np.int64).min))
            key, counts = np.unique(row * (BINS + 1) + bins[row, col], return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "size": np.full(len(key), size, np.int32),
                    "place": (key // (BINS + 1)).astype(np.int32),
                    "bin": (key % (BINS + 1)).astype(np.int32),
                    "count": counts.astype(np.int64),
                }
            )

    return count


def _kth_scores(vectors: DataFrame, blocks: dict, k: int) -> dict[int, np.ndarray]:
    """For each query a score that at least k candidates reach, and no higher one does.

    Queries with fewer than k candidates get the lowest score possible.
    """
    lows, highs = {}, {}
    for size, (ids, queries) in blocks.items():
        bound = np.abs(queries).sum(axis=1)
        largest = vectors.filter(F.size("vector") == size).agg(
            F.max(F.greatest(F.abs(F.floor(SCALE * F.array_max("vector"))),
                             F.abs(F.floor(SCALE * F.array_min("vector")))))
        ).first()[0]
        reach = [int(b) * int(largest or 0) for b in bound]
        if max(reach, default=0) >= 1 << 62:
            raise OverflowError("scores need more than 64 bits")
        highs[size] = np.array(reach, dtype=np.int64) + 1
        lows[size] = -highs[size]
    while any((highs[s] - lows[s] > 1).any() for s in blocks):
        counted = vectors.mapInArrow(
            _histograms(blocks, lows, highs, k), "size int, place int, bin int, count long"
        )
        # a row for each query of the block and bin that some task's k best fall into
        rows = counted.groupBy("size", "place", "bin").agg(F.sum("count").alias("n"))
        above = Window.partitionBy("size", "place").orderBy(F.desc("bin"))
        reached = (
            rows.withColumn("upto", F.sum("n").over(above))
            .filter(F.col("upto") >= k)
            .groupBy("size", "place")
            .agg(F.max("bin").alias("bin"))
            .toArrow()
        )
        found = {s: np.full(len(lows[s]), -1, np.int64) for s in blocks}
        for s, place, bin_ in zip(*(c.to_pylist() for c in reached.columns), strict=True):
            found[s][place] = bin_
        for s in blocks:
            width = np.maximum(1, -(-(highs[s] - lows[s]) // BINS))
            inside = found[s] >= 0
            low = np.where(inside, lows[s] + found[s] * width, lows[s])
            lows[s], highs[s] = low, np.where(inside, np.minimum(low + width, highs[s]), low + 1)
    return lows


def _reaching(blocks: dict, floors: dict, k: int):
    """Candidates above the k-th score, and a task's k smallest ids of those that tie there."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for query_ids, ids, scores, size in _tiles(batches, blocks):
            reach = (scores >= floors[size][:, None]) & (query_ids[:, None] != ids[None, :])
            row, col = np.nonzero(reach)
            new = np.stack((row, scores[row, col], ids[col]))
            old = held.get(size)
            both = new if old is None else np.concatenate((old, new), axis=1)
            order = np.lexsort((both[2], -both[1], both[0]))
            both = both[:, order]
            starts = np.searchsorted(both[0], both[0])
            held[size] = both[:, np.arange(both.shape[1]) - starts < k]
        for size, (row, score, vec) in held.items():
            yield pa.RecordBatch.from_pydict(
                {"query_id": blocks[size][0][row], "vec_id": vec, "score": score}
            )

    return collect


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k best candidates of every row for which ``queries`` holds: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    usable = vectors.filter(_usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    vectors_ = usable.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
    )
    asked = usable.filter(queries).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
    )
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    asked = stage(asked.distinct().withColumn("block", block), "queries") if n_blocks > 1 else asked.distinct()
    found = []
    for b in range(n_blocks):
        one = asked.filter(F.col("block") == b) if n_blocks > 1 else asked
        table = one.select("vec_id", "vector").toArrow()
        by_size: dict[int, list] = {}
        for vec, vector in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
            by_size.setdefault(len(vector), []).append((vec, np.array(vector, dtype=np.float64)))
        if not by_size:
            continue
        blocks = {
            size: (np.array([x[0] for x in rows], np.int64), scaled([x[1] for x in rows]))
            for size, rows in by_size.items()
        }
        floors = _kth_scores(vectors_, blocks, k)
        found.append(
            stage(
                vectors_.mapInArrow(
                    _reaching(blocks, floors, k), "query_id long, vec_id long, score long"
                ),
                "reached",
            )
        )
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
