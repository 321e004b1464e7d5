"""Vector codes from codebooks learned by rounds of nearest-entry assignment, with equal-average search.

Each component x counts as floor(1024 * x). Vectors are cut into consecutive parts, equal in length or longer by
one at the front, and each part position has a codebook of its own, which starts as that part of the rows with
the smallest ids. A round assigns each part to its nearest entry and replaces each entry by the floor of the mean
of its parts; entries without parts stay. After the last round parts are assigned once more.

The nearest entry is found by equal-average search: entries are sorted by the sum of their components, and from
the place of the part's own sum the search goes outward on both sides. As the squared distance is at least
the squared gap of the sums divided by the dimension, a side ends where that bound strictly exceeds the best
distance found; entries at the same distance are thus all seen, and the one of the lower number is taken. All
parts of a batch go through the steps together, and those that are done leave.

Codebooks are bounded (entries by components) and travel with the tasks; sums are combined in each task and
added up in Spark, so only entries reach the driver. All numbers are whole and every result exact.

Rows whose vector is null, empty or holds a null or non-finite component are left out, as are vectors of another
length than that of the smallest id. Rows without an id come after all others. Rows that share an id are separate
rows; of equal ids the smaller vector counts as the smaller. With fewer rows than entries the codebooks are as
small as the table. Null labels are one label. A component so large that a squared sum over a vector may need more
than 62 bits raises OverflowError. Only the three named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches
from mercatura.llm.vectors import matrices, usable
from mercatura.session import stage

SCALE = 1024
#: Entries whose distances are computed at a time.
TILE = 1 << 14
RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest entry and squared distance for each part, and how many distances that took."""
    dimension = parts.shape[1]
    sums = entries.sum(axis=1)
    order = np.lexsort((np.arange(len(entries)), sums))
    sums, ordered = sums[order], entries[order]
    own = parts.sum(axis=1)
    best = np.full(len(parts), np.iinfo(np.int64).max // dimension)
    number = np.zeros(len(parts), np.int64)
    computed = 0
    up = np.searchsorted(sums, own)
    # rows still searching on each side, and the place in sum order they look at next
    sides = [(np.arange(len(parts)), up - 1, -1), (np.arange(len(parts)), up, 1)]
    while any(len(rows) for rows, _, _ in sides):
        for side, (rows, at, step) in enumerate(sides):
            inside = (at >= 0) & (at < len(sums))
            rows, at = rows[inside], at[inside]
            gap = sums[at] - own[rows]
            going = gap * gap <= best[rows] * dimension
            rows, at = rows[going], at[going]
            difference = parts[rows] - ordered[at]
            distance = np.einsum("nd,nd->n", difference, difference)
            computed += len(rows)
            entry = order[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (entry < number[rows]))
            best[rows[better]] = distance[better]
            number[rows[better]] = entry[better]
            sides[side] = (rows, at + step, step)
    return number, best, computed


def limit(dimension: int) -> float:
    """Components below it keep squared sums of differences, and distances times the dimension, in 62 bits."""
    return (1 << 30) / dimension


def cuts(dimension: int, parts: int) -> list[slice]:
    """Consecutive parts of a vector, as equal as possible; longer ones first."""
    edges = np.cumsum([0, *(len(x) for x in np.array_split(np.arange(dimension), parts))])
    return [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def _parts(batch: pa.RecordBatch, codebooks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(rows of the batch, their parts, part position, codebook) in tiles."""
    dimension = sum(c.shape[1] for c in codebooks)
    for rows, vectors in matrices(batch.column("vector"), SCALE, limit(dimension)):
        if vectors.shape[1] != dimension:
            continue
        vectors = vectors.astype(np.int64)
        for position, (cut, entries) in enumerate(zip(cuts(dimension, len(codebooks)), codebooks, strict=True)):
            for a in range(0, len(rows), TILE):
                yield rows[a : a + TILE], vectors[a : a + TILE, cut], position, entries


def _updated(vectors: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry as the floor of the mean of the parts assigned to it."""
    width = max(c.shape[1] for c in codebooks)
    names = [f"s{k}" for k in range(width)]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(c), width), np.int64) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        for batch in batches:
            for _, parts, position, entries in _parts(batch, codebooks):
                number, _, _ = nearest(parts, entries)
                np.add.at(sums[position][:, : parts.shape[1]], number, parts)
                counts[position] += np.bincount(number, minlength=len(entries))
        for position, (total, count) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(count)
            columns = [np.full(len(used), position, np.int32), used.astype(np.int32), count[used], *total[used].T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["position", "entry", "n", *names])

    schema = "position int, entry int, n long, " + ", ".join(f"{n} long" for n in names)
    added = vectors.select("vector").mapInArrow(add_up, schema).groupBy("position", "entry")
    table = added.agg(*(F.sum(c).alias(c) for c in ["n", *names])).toArrow()
    found = [c.copy() for c in codebooks]
    totals = np.stack([table[n].to_numpy() for n in names], axis=1)
    means = totals // table["n"].to_numpy()[:, None]
    for position, book in enumerate(found):
        mine = table["position"].to_numpy() == position
        book[table["entry"].to_numpy()[mine]] = means[mine][:, : book.shape[1]]
    return found


def learn(vectors: DataFrame, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks of all part positions; none for an empty table. ``vectors``: vec_id, vector."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").toArrow()
    if not first.num_rows:
        return []
    dimension = len(first["vector"][0])
    same = [v for v in first["vector"].to_pylist() if len(v) == dimension]
    if len(same) < first.num_rows:
        kept = vectors.filter(F.size("vector") == dimension).orderBy(F.asc_nulls_last("vec_id"), "vector")
        same = kept.limit(entries).select("vector").toArrow()["vector"].to_pylist()
    (_, start), = matrices(pa.array(same, pa.list_(pa.float64())), SCALE, limit(dimension))
    start = start.astype(np.int64)
    codebooks = [np.ascontiguousarray(start[:, cut]) for cut in cuts(dimension, parts)]
    for _ in range(rounds):
        codebooks = _updated(vectors, codebooks)
    return codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, joined by commas."""
    numbers = (str(x) for book in codebooks for x in book.reshape(-1).tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """Code and error of every vector: vec_id, label, code, error. ``vectors``: vec_id, label, vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dimension = sum(c.shape[1] for c in codebooks)
        for batch in batches:
            numbers = np.zeros((batch.num_rows, len(codebooks)), np.int64)
            errors = np.zeros(batch.num_rows, np.int64)
            for rows, parts, position, entries in _parts(batch, codebooks):
                number, distance, _ = nearest(parts, entries)
                numbers[rows, position] = number
                errors[rows] += distance
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            kept = np.flatnonzero(sizes == dimension)
            digits = max(2, len(f"{max(len(c) for c in codebooks) - 1:x}"))
            codes = ["".join(f"{x:0{digits}x}" for x in row) for row in numbers[kept].tolist()]
            some = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [some["vec_id"], some["label"], pa.array(codes, pa.string()), pa.array(errors[kept])],
                names=["vec_id", "label", "code", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "vector").mapInArrow(
        assign, f"vec_id long, label {label}, code string, error long"
    )


def compress(
    table: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Every vector's code: vec_id, code, error, label_error, codebooks_sha256."""
    spark = table.sparkSession
    bounded_batches(spark)
    vectors = table.filter(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    codebooks = learn(vectors, parts, entries, rounds)
    if not codebooks:
        return spark.createDataFrame([], RESULT)
    coded = stage(encode(vectors, codebooks), "codes")
    # a written table, so that Spark knows whether the labels are few enough to be sent to all tasks
    totals = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    of_label = totals.withColumnRenamed("label", "of_label")
    joined = coded.join(of_label, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
