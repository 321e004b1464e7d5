"""Hard negatives: rows of another label that score nearly as high as a row of the anchor's own label.

Each component x counts as floor(256 * x); a score is the integer inner product with the anchor. Higher scores
come first, then smaller ids. An anchor's positives are its first rows of the same label. A negative is a row of
another label whose score reaches a share of the positive's score without exceeding it.

Both searches prune by length and coordinates. A task collects rows, sorts them by length and cuts them into
buckets of similar length, with a sorted list of each coordinate of the rows scaled to length one. For an anchor
and a score worth having, a bucket gives a least cosine: the score divided by the anchor's length and the
bucket's largest. Beyond one, the bucket and all shorter ones are passed over. Otherwise each of the anchor's
focus coordinates, its largest, has a range that the coordinate of any row with such a cosine lies in; the range
is a run of the sorted list, the runs of all focus coordinates are intersected, and only rows in all of them
are scored exactly. What is worth having rises with the best rows found. All anchors of a tile go through the
steps together.

Anchors are taken in passes of bounded size that travel with the tasks; a pass scans the vectors twice, and a
task returns a few rows for each anchor. No row is left out of either search.

Rows with a null label or a vector that is null, empty or holds a null or non-finite component take no part, and
neither do rows without an id. An anchor meets only vectors of its own length, and a row with its id is its own.
Rows that share an id are separate rows; an anchor id that occurs with several vectors or labels is an anchor for
each. An anchor without positives, or a positive without negatives, gives no rows. Components of 2^24 / 256 or
more raise OverflowError. Only the three named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches
from mercatura.llm.vectors import matrices, usable
from mercatura.session import stage

SCALE, LIMIT = 256, float(1 << 24)
#: Bytes of anchors in a pass, rows a task collects, rows of a bucket, anchors of a tile, focus coordinates.
PASS_BYTES, CHUNK, BUCKET, TILE, FOCUS = 32 << 20, 1 << 15, 1024, 256, 3
#: Share of a tile's pairs from which one product of the tile is cheaper than single scores.
DENSE = 1 / 16
#: Room for rounding, so that bounds never leave out a row that just reaches them.
SLACK = 1e-9
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
LOWEST = -float(1 << 62)


class Anchors:
    """Anchors of one length: their numbers, ids, labels and vectors, with what prunes by length and coordinates."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.numbers, self.ids, self.labels, self.vectors = numbers, ids, labels, vectors
        self.lengths = np.sqrt(np.einsum("nd,nd->n", vectors, vectors))
        unit = vectors / np.maximum(self.lengths, 1)[:, None]
        focus = min(FOCUS, vectors.shape[1])
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :focus]
        self.values = np.take_along_axis(unit, self.focus, axis=1)


class Bucket:
    """Rows of similar length, with the place of each in the sorted list of every coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.longest = lengths.max()
        unit = vectors / np.maximum(lengths, 1)[:, None]
        order = np.argsort(unit, axis=0, kind="stable")
        self.lists = np.take_along_axis(unit, order, axis=0)
        self.places = np.empty(order.shape, np.int32)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)


def buckets(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[Bucket]:
    """Rows cut into buckets, longest first."""
    lengths = np.sqrt(np.einsum("nd,nd->n", vectors, vectors))
    order = np.argsort(-lengths, kind="stable")
    cut = [order[a : a + BUCKET] for a in range(0, len(order), BUCKET)]
    return [Bucket(ids[c], labels[c], vectors[c], lengths[c]) for c in cut]


def feasible(value: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of a unit vector's coordinate, if its cosine with a unit vector is at least ``cosine``.

    ``value`` is that unit vector's coordinate. Where the cosine asks for nothing, the range is everything.
    """
    cosine = np.minimum(cosine, 1) - SLACK
    reach = np.sqrt(np.maximum(1 - value * value, 0) * np.maximum(1 - cosine * cosine, 0)) + SLACK
    low = np.where((cosine <= 0) | (value <= -cosine), -2.0, value * cosine - reach)
    high = np.where((cosine <= 0) | (value >= cosine), 2.0, value * cosine + reach)
    return low, high


def candidates(bucket: Bucket, anchors: Anchors, some: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of ``some`` anchors and of the bucket's rows) that may reach the score ``worth`` having.

    Returned as a mask of anchors by rows, and the anchors that the mask is for.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(worth > 0, worth / (anchors.lengths[some] * bucket.longest), 0.0)
    reached = ~(cosine > 1 + SLACK)
    some, cosine = some[reached], cosine[reached]
    mask = np.ones((len(some), len(bucket.ids)), dtype=bool)
    for f in range(anchors.focus.shape[1]):
        coordinate = anchors.focus[some, f]
        low, high = feasible(anchors.values[some, f], cosine)
        first, last = np.empty(len(some), np.int32), np.empty(len(some), np.int32)
        for c in np.unique(coordinate):
            mine = coordinate == c
            first[mine] = np.searchsorted(bucket.lists[:, c], low[mine], side="left")
            last[mine] = np.searchsorted(bucket.lists[:, c], high[mine], side="right")
        narrow = np.flatnonzero((first > 0) | (last < len(bucket.ids)))
        if len(narrow):
            places = bucket.places[:, coordinate[narrow]].T
            mask[narrow] &= (places >= first[narrow, None]) & (places < last[narrow, None])
    return mask, some


def scores(bucket: Bucket, anchors: Anchors, some: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
    """Exact scores of the pairs in the mask: anchor, row, score. Sums of whole numbers stay exact in doubles."""
    a, r = np.nonzero(mask)
    if len(a) > DENSE * mask.size:
        return some[a], r, (anchors.vectors[some] @ bucket.vectors.T)[a, r]
    found = [np.zeros(0)]
    for k in range(0, len(a), 1 << 15):
        found.append(np.einsum("nd,nd->n", anchors.vectors[some[a[k : k + (1 << 15)]]], bucket.vectors[r[k : k + (1 << 15)]]))
    return some[a], r, np.concatenate(found)


class Best:
    """The best k rows found so far for each group, and the score a row needs to come among them."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least, self.worth = k, least, least.copy()
        self.scores = np.full((len(least), k), LOWEST)
        self.ids = np.full((len(least), k), np.iinfo(np.int64).max)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        useful = score >= self.worth[group]
        group, score, ids = group[useful], score[useful], ids[useful]
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        first = rank < self.k
        groups, row = np.unique(group[first], return_inverse=True)
        scores = np.concatenate((self.scores[groups], np.full((len(groups), self.k), LOWEST)), axis=1)
        names = np.concatenate((self.ids[groups], np.full((len(groups), self.k), np.iinfo(np.int64).max)), axis=1)
        scores[row, self.k + rank[first]] = score[first]
        names[row, self.k + rank[first]] = ids[first]
        order = np.lexsort((names, -scores), axis=-1)[:, : self.k]
        self.scores[groups] = np.take_along_axis(scores, order, axis=1)
        self.ids[groups] = np.take_along_axis(names, order, axis=1)
        self.worth[groups] = np.maximum(self.least[groups], self.scores[groups, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, id and score of all rows held."""
        group, place = np.nonzero(self.scores > LOWEST)
        return group, self.ids[group, place], self.scores[group, place].astype(np.int64)


def _search(by_size: dict[int, Anchors], judge: Callable) -> Callable:
    """A pass over a task's rows: collects them and hands their buckets and the anchors to the judge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {size: [] for size in by_size}
        judges = {size: judge(anchors) for size, anchors in by_size.items()}

        def flush(size: int) -> None:
            if held[size]:
                ids, labels, vectors = (np.concatenate(x) for x in zip(*held[size], strict=True))
                held[size] = []
                for bucket in buckets(ids, labels, vectors):
                    judges[size].look(bucket)

        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            for rows, vectors in matrices(batch.column("vector"), SCALE, LIMIT):
                size = vectors.shape[1]
                if size in by_size:
                    held[size].append((ids[rows], labels[rows], vectors))
                    if sum(len(x[0]) for x in held[size]) >= CHUNK:
                        flush(size)
        for size in by_size:
            flush(size)
            yield from judges[size].result()

    return run


class Positives:
    """The first rows of an anchor's own label."""

    def __init__(self, anchors: Anchors, k: int):
        self.anchors = anchors
        self.best = Best(np.full(len(anchors.ids), LOWEST), k)

    def look(self, bucket: Bucket) -> None:
        for at in range(0, len(self.anchors.ids), TILE):
            some = np.arange(at, min(at + TILE, len(self.anchors.ids)))
            mask, some = candidates(bucket, self.anchors, some, self.best.worth[some])
            mask &= self.anchors.labels[some, None] == bucket.labels
            mask &= self.anchors.ids[some, None] != bucket.ids
            a, r, score = scores(bucket, self.anchors, some, mask)
            self.best.add(a, score, bucket.ids[r])

    def result(self) -> Iterator[pa.RecordBatch]:
        group, ids, score = self.best.rows()
        columns = [self.anchors.numbers[group], ids, score]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "vec_id", "score"])


class Negatives:
    """For each target (anchor and positive), the first rows of other labels with a score in its range."""

    def __init__(self, anchors: Anchors, owner: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        order = np.argsort(owner, kind="stable")
        self.anchors, self.owner, self.target = anchors, owner[order], target[order]
        self.low, self.high = low[order], high[order]
        self.first = np.searchsorted(self.owner, np.arange(len(anchors.ids) + 1))
        self.best = Best(self.low, k)

    def look(self, bucket: Bucket) -> None:
        asked = np.flatnonzero(np.diff(self.first))
        for at in range(0, len(asked), TILE):
            some = asked[at : at + TILE]
            worth = np.minimum.reduceat(self.best.worth, self.first[some])
            mask, some = candidates(bucket, self.anchors, some, worth)
            mask &= self.anchors.labels[some, None] != bucket.labels
            mask &= self.anchors.ids[some, None] != bucket.ids
            a, r, score = scores(bucket, self.anchors, some, mask)
            count = self.first[a + 1] - self.first[a]
            for k in range(int(count.max(initial=0))):
                has = count > k
                target = self.first[a[has]] + k
                inside = score[has] <= self.high[target]
                self.best.add(target[inside], score[has][inside], bucket.ids[r[has][inside]])

    def result(self) -> Iterator[pa.RecordBatch]:
        group, ids, score = self.best.rows()
        columns = [self.target[group], ids, score]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["target", "vec_id", "score"])


def _ranked(found: DataFrame, group: str, k: int) -> DataFrame:
    best = Window.partitionBy(group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)


def _anchors(table: pa.Table) -> dict[int, Anchors]:
    ids, labels = (table[c].to_numpy() for c in ("vec_id", "label"))
    found = {}
    for rows, vectors in matrices(table["vector"], SCALE, LIMIT):
        if vectors.shape[1] * np.abs(vectors).max(initial=0) * LIMIT >= 1 << 52:
            raise OverflowError("scores need more than 52 bits")
        found[vectors.shape[1]] = Anchors(rows, ids[rows], labels[rows], vectors)
    return found


def _one_pass(rows: DataFrame, table: pa.Table, k: int, share: tuple[int, int]) -> DataFrame | None:
    """The negatives of one pass of anchors, written."""
    spark = rows.sparkSession
    by_size = _anchors(table)
    searched = rows.mapInArrow(_search(by_size, lambda anchors: Positives(anchors, k)), "anchor long, vec_id long, score long")
    positives = _ranked(searched, "anchor", k).select("anchor", "vec_id", "score").toArrow().sort_by(
        [("anchor", "ascending"), ("score", "descending"), ("vec_id", "ascending")]
    )
    if not positives.num_rows:
        return None
    of, score = positives["anchor"].to_numpy(), positives["score"].to_numpy()
    high = score.astype(np.float64)
    low = -((-share[0] * score) // share[1]).astype(np.float64)  # the least whole score that reaches the share

    def judge(anchors: Anchors) -> Negatives:
        owner = np.searchsorted(anchors.numbers, of)
        known = anchors.numbers[np.minimum(owner, len(anchors.numbers) - 1)] == of
        mine = np.flatnonzero(known & (low <= high))
        return Negatives(anchors, owner[mine], mine, low[mine], high[mine], k)

    searched = rows.mapInArrow(_search(by_size, judge), "target long, vec_id long, score long")
    found = _ranked(searched, "target", k)
    named = pa.table({
        "target": pa.array(np.arange(len(of))), "anchor_id": table["vec_id"].take(pa.array(of)),
        "positive_id": positives["vec_id"], "positive_score": positives["score"],
    })
    targets = spark.createDataFrame(named)
    return stage(
        found.join(targets, "target").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ),
        "negatives",
    )


def hard_negatives(
    table: DataFrame,
    anchors: Column,
    label: Column,
    k: int = 5,
    share: tuple[int, int] = (80, 100),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Negatives of every row for which ``anchors`` holds, for each of its first ``k`` positives.

    A negative scores at least ``share`` of the positive, and no more than it.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    rows = table.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).withColumns(
        {"_label": label.cast("long"), "_asked": anchors}
    )
    rows = rows.filter("_label IS NOT NULL")
    columns = [F.col(id_col).cast("long").alias("vec_id"), F.col("_label").alias("label"), F.col(vector_col).alias("vector")]
    asked = rows.filter("_asked").select(*columns).distinct()
    size, most = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    passes = max(1, -(-8 * size * (most or 0) // PASS_BYTES))
    if passes > 1:
        asked = stage(asked.withColumn("turn", F.pmod(F.xxhash64("vec_id", "label"), F.lit(passes))), "anchors")
    found = []
    for turn in range(passes):
        one = asked.filter(F.col("turn") == turn).drop("turn") if passes > 1 else asked
        one = one.orderBy("vec_id", "label", "vector").toArrow()
        if one.num_rows:
            found.append(_one_pass(rows.select(*columns), one, k, share))
    found = [f for f in found if f is not None]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)
