"""MinHash signatures, LSH bands, and candidate pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from mercatura.functions.minhash import (
    BANDS,
    PRIME,
    ROWS,
    SEED,
    bucket_key,
    coefficients,
    shingle_hash,
)
from mercatura.operators.joins import join_by_key
from mercatura.operators.shingles import shingle_rows
from mercatura.session import new_table_path, stage

BUCKET = ["band_id", "bucket_hash"]
# Fixed value: the similarity that merges.
MERGE_THRESHOLD = 0.55
# Minima per aggregate: more columns than this make generated code too large to be compiled.
MAX_WIDTH = 32


@dataclass(frozen=True)
class Layout:
    """Signature of ``bands * rows`` minima, computed in parts of whole bands."""

    bands: int = BANDS
    rows: int = ROWS
    seed: int = SEED

    @property
    def bands_per_part(self) -> int:
        return max(1, MAX_WIDTH // self.rows)

    @property
    def width(self) -> int:
        return self.bands_per_part * self.rows

    @property
    def parts(self) -> int:
        return -(-self.bands // self.bands_per_part)


DEFAULT = Layout()
# The older layout of 14 bands of 9 rows.
OLDER = Layout(bands=14, rows=9)


def signature_parts(rows: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Minima per document and signature part: ``doc, part, m0 .. m{width-1}``.

    A signature is split over rows instead of columns. Each part is an aggregate narrow enough for
    compiled code, minima combine in the map tasks, first in each batch, and bands are cut from a part on its
    own, so the parts of a document never need to be joined up.
    """
    hashed = rows.select("doc", shingle_hash(F.col("shingle")).alias("h"))
    shape = T.StructType([hashed.schema["doc"], T.StructField("part", T.IntegerType())])
    for i in range(layout.width):
        shape.add(f"m{i}", T.LongType())
    return least_parts(hashed.mapInArrow(_batch_minima(layout), shape), layout)


def least_parts(parts: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """One row for each document and signature part, of the minima of all its rows."""
    names = [f"m{i}" for i in range(layout.width)]
    return parts.groupBy("doc", "part").agg(*[F.min(name).alias(name) for name in names])


def _batch_minima(layout: Layout) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Minima of the rows that a batch has of each document; those of its batches are combined afterwards."""
    pairs = coefficients(layout.parts * layout.width, layout.seed)
    factors, addends = np.array(pairs, np.uint64).T
    parts, width, prime, exponent = layout.parts, layout.width, np.uint64(PRIME), np.uint64(31)
    names = ["doc", "part", *(f"m{i}" for i in range(width))]

    def of_runs(h: np.ndarray, none: np.ndarray | None, starts: np.ndarray) -> np.ndarray:
        """Minima by function and run of ``h``; the prime where a run has no hash."""
        least = np.empty((len(factors), len(starts)), np.uint64)
        h = h % prime
        x, y = np.empty_like(h), np.empty_like(h)
        for i in range(len(factors)):
            np.multiply(h, factors[i], out=x)
            np.add(x, addends[i], out=x)
            # modulo 2**31 - 1, the bits from the 31st on count as a number of their own; it is below the prime too
            np.right_shift(x, exponent, out=y)
            np.bitwise_and(x, prime, out=x)
            np.add(x, y, out=x)
            # below the prime the difference wraps around
            np.subtract(x, prime, out=y)
            np.minimum(x, y, out=x)
            if none is not None:
                x[none] = prime
            np.minimum.reduceat(x, starts, out=least[i])
        return least

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch["doc"].dictionary_encode(null_encoding="encode")
            code = docs.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
            none = batch["h"].is_null().to_numpy(zero_copy_only=False)[order] if batch["h"].null_count else None
            h = batch["h"].fill_null(0).to_numpy().astype(np.uint64)[order]
            least = of_runs(h, none, starts).reshape(parts, width, len(starts))
            found = docs.dictionary.take(pa.array(code[order][starts]))
            for part in range(parts):
                values = [pa.array(x.astype(np.int64), pa.int64(), mask=x == prime) for x in least[part]]
                columns = [found, pa.array(np.full(len(starts), part, np.int32)), *values]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return minima


def signature_values(parts: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Signatures in long form: ``doc, position, min_hash``."""
    values = F.array(*[F.col(f"m{i}") for i in range(layout.width)])
    return (
        parts.select("doc", "part", F.posexplode(values).alias("at", "min_hash"))
        .select("doc", (F.col("part") * layout.width + F.col("at")).alias("position"), "min_hash")
        .filter(F.col("position") < layout.bands * layout.rows)
    )


def band_rows(parts: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Bucket of each band: ``doc, band_id, bucket_hash``. Documents without shingles have none."""
    cells = F.array(
        *[
            F.struct(
                (F.col("part") * layout.bands_per_part + j).cast("int").alias("band_id"),
                bucket_key(
                    [F.col(f"m{i}") for i in range(j * layout.rows, (j + 1) * layout.rows)]
                ).alias("bucket_hash"),
            )
            for j in range(layout.bands_per_part)
        ]
    )
    return parts.select("doc", F.inline(cells)).filter(F.col("band_id") < layout.bands)


def bucket_sizes(bands: DataFrame) -> DataFrame:
    return bands.groupBy(*BUCKET).agg(F.count("*").alias("n_members"))


def different_buckets(bands: DataFrame) -> DataFrame:
    """Buckets of two members or more with their size ``n``, one of each different set of members.

    Near copies share most of their buckets, so most sets of members occur in many bands. Sets are told apart
    by their size and two sums of hashes of the members.
    """
    member = [F.xxhash64(F.lit(salt), "doc").cast("decimal(38,0)") for salt in (0, 1)]
    sets = bands.groupBy(*BUCKET).agg(
        F.count("*").alias("n"), F.sum(member[0]).alias("s"), F.sum(member[1]).alias("t")
    )
    first = F.min(F.struct(*BUCKET)).alias("first")
    return sets.filter("n > 1").groupBy("n", "s", "t").agg(first).select("first.*", "n")


def rarest_shingles(
    documents: DataFrame, frequency: DataFrame, threshold: float = MERGE_THRESHOLD
) -> DataFrame:
    """The shingles of each document that a partner of at least ``threshold`` cannot all miss.

    In rarest-first order, sets with Jaccard of at least t share one of their first
    ``n - ceil(t * n) + 1`` shingles (prefix filtering).
    """
    ranked = join_by_key(shingle_rows(documents), frequency, ["shingle"])
    order = Window.partitionBy("doc").orderBy("df", "shingle")
    whole = Window.partitionBy("doc")
    needed = F.ceil(F.col("n_shingles") * threshold - 1e-6)
    return (
        ranked.select(
            "doc",
            "shingle",
            F.row_number().over(order).alias("rank"),
            F.count("*").over(whole).alias("n_shingles"),
        )
        .filter(F.col("rank") <= F.col("n_shingles") - needed + 1)
        .select("doc", "shingle", "n_shingles")
    )


def rare_prefixes(
    documents: DataFrame, frequency: DataFrame, threshold: float = MERGE_THRESHOLD
) -> DataFrame:
    """Each document's rarest shingles as an array of hashes: ``doc, n_shingles, prefix``."""
    rarest = rarest_shingles(documents, frequency, threshold)
    return rarest.groupBy("doc", "n_shingles").agg(F.collect_list(F.xxhash64("shingle")).alias("prefix"))


# Members from which a bucket is a crowd, whose members may meet under one of their rarest shingles instead.
CROWD = 64
# Members of a bucket that each task holds against the others.
SPREAD = 1024
MEETING = [*BUCKET, "meet"]


def divided_crowds(sized: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Crowds with fewer pairs under their rarest shingles than among all members: ``band_id, bucket_hash``.

    A crowd of unrelated documents is divided by its rarest shingles. Near copies share most of these, so each of
    their pairs would be formed once for every one; such a crowd stays whole.
    """
    many = sized.filter(F.col("n") > CROWD).join(prefixes.select("doc", "prefix"), "doc")
    under = many.select("n", *BUCKET, F.explode("prefix").alias("meet")).groupBy("n", *MEETING).agg(
        F.count("*").cast("double").alias("k")
    )
    formed = under.groupBy("n", *BUCKET).agg(F.sum(F.col("k") * (F.col("k") - 1)).alias("formed"))
    n = F.col("n").cast("double")
    return formed.filter(F.col("formed") < n * (n - 1)).select(*BUCKET)


def meeting_rows(rows: DataFrame, divided: DataFrame, prefixes: DataFrame) -> DataFrame:
    """What documents can meet under: ``rows`` with ``meet``.

    In most buckets all members meet, under 0. In the ``divided`` ones they meet under each of their rarest
    shingles. Documents that ``may_match`` meet in either case, so ``divided`` decides the plan and not the result.
    """
    whole = join_by_key(rows, divided, BUCKET, "left_anti").withColumn("meet", F.lit(0).cast("bigint"))
    many = join_by_key(rows, divided, BUCKET, "left_semi").join(prefixes.select("doc", "prefix"), "doc")
    return whole.unionByName(many.select(*rows.columns, F.explode("prefix").alias("meet")))


def _matchable(crowd: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Meeting rows with what a pair is judged by: ``n_shingles``, ``prefix``, and all ``buckets`` of the document.

    ``crowd`` has the size ``n`` of each row's bucket. Documents that meet under a shingle share it already, so
    their rows go without ``prefix``.
    """
    divided = stage(divided_crowds(crowd, prefixes), "divided")
    rows = meeting_rows(crowd, divided, prefixes).join(prefixes, "doc").join(_buckets(crowd), "doc")
    whole = F.col("meet") == 0
    return rows.select(
        "doc", *MEETING, "n_shingles", F.when(whole, F.col("prefix")).alias("prefix"), "buckets",
        F.when(whole, _slices(F.col("n"))).otherwise(F.lit(1)).alias("slices"),
    )


def may_match(pairs: DataFrame, prefixes: DataFrame, a: str, b: str, threshold: float = MERGE_THRESHOLD) -> DataFrame:
    """Pairs whose sizes allow ``threshold`` and which share one of their rarest shingles."""
    sides = [
        prefixes.select(F.col("doc").alias(doc), F.col("n_shingles").alias(f"n_{doc}"), F.col("prefix").alias(f"p_{doc}"))
        for doc in (a, b)
    ]
    sizes = (F.col(f"n_{a}"), F.col(f"n_{b}"))
    compatible = F.least(*sizes) >= F.greatest(*sizes) * threshold - 1e-6
    both = pairs.join(sides[0], a).join(sides[1], b)
    return both.filter(compatible & F.arrays_overlap(f"p_{a}", f"p_{b}")).select(*pairs.columns)


def _slices(n: Column) -> Column:
    """How many slices a bucket of ``n`` members is cut into."""
    return F.ceil(n / SPREAD).cast("int")


def _buckets(crowd: DataFrame) -> DataFrame:
    """All buckets of each document, as hashes: ``doc, buckets``."""
    return crowd.groupBy("doc").agg(F.collect_set(F.xxhash64(*BUCKET)).alias("buckets"))


def _paired(a: DataFrame, b: DataFrame, key: list[str], match: Column) -> DataFrame:
    """Pairs of documents that meet under ``key`` and fit ``match``, each once.

    They are judged where they meet, in the first bucket that holds both, so neither the pairs of their other
    buckets nor prefixes by pair are shuffled. The members of a large bucket are cut into slices, each held against
    all of it by a task of its own.
    """
    a = a.withColumn("slice", F.pmod(F.xxhash64("doc"), F.col("slices")).cast("int"))
    b = b.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    for name in [*key, "slice"]:
        match = match & (F.col(f"a.{name}") == F.col(f"b.{name}"))
    first = F.array_min(F.array_intersect("a.buckets", "b.buckets"))
    match = match & (first == F.xxhash64(*[F.col(f"a.{name}") for name in BUCKET]))
    docs = (F.col("a.doc"), F.col("b.doc"))
    return (
        a.alias("a").join(b.alias("b"), match)
        .select(F.least(*docs).alias("doc_a"), F.greatest(*docs).alias("doc_b"))
        .distinct()
    )


def _met(a: DataFrame, b: DataFrame, apart: Column, threshold: float) -> DataFrame:
    """Pairs of documents of ``_matchable`` rows that meet and may reach ``threshold``, each once."""
    sizes = (F.col("a.n_shingles"), F.col("b.n_shingles"))
    match = apart & (F.least(*sizes) >= F.greatest(*sizes) * threshold - 1e-6)
    match = match & (F.col("a.prefix").isNull() | F.arrays_overlap("a.prefix", "b.prefix"))
    return _paired(a, b, MEETING, match)


def bucket_pairs(bands: DataFrame) -> DataFrame:
    """All documents that share a bucket, whatever their similarity: ``doc_a < doc_b``, each pair once.

    The pairs are the output, which is quadratic in the size of the buckets. ``bands`` is read several times and
    should be a stored table.
    """
    crowd = stage(join_by_key(bands, different_buckets(bands), BUCKET), "crowd")
    rows = crowd.join(_buckets(crowd), "doc").select("doc", *BUCKET, "buckets", _slices(F.col("n")).alias("slices"))
    rows = stage(rows, "meeting")
    return _paired(rows, rows, BUCKET, F.col("a.doc") < F.col("b.doc"))


def candidate_pairs(
    bands: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    labels: DataFrame | None = None,
    threshold: float = MERGE_THRESHOLD,
) -> DataFrame:
    """Documents that share a bucket and may reach ``threshold``: ``doc_a < doc_b``, each pair once.

    They share one of their rarest shingles and have compatible sizes, as all pairs of that similarity do, so
    verification loses nothing. The definition is the same for buckets of every size. With
    ``labels(doc, label)`` only pairs across labels are formed. ``bands`` and ``frequency`` are read several
    times and should be stored tables.
    """
    crowd = stage(join_by_key(bands, different_buckets(bands), BUCKET), "crowd")
    members = documents.join(crowd.select("doc").distinct(), "doc", "left_semi")
    prefixes = stage(rare_prefixes(members, frequency, threshold), "prefixes")
    rows = _matchable(crowd, prefixes)
    if labels is None:
        rows = rows.withColumn("label", F.col("doc"))
    else:
        rows = rows.join(labels, "doc", "left").withColumn(
            "label", F.coalesce("label", F.col("doc"))
        )
    rows = stage(rows, "meeting")
    apart = (F.col("a.doc") < F.col("b.doc")) & (F.col("a.label") != F.col("b.label"))
    return stage(_met(rows, rows, apart, threshold), "met")


def _touched(bands: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of the buckets that a batch falls into, marked ``is_incoming``; the rest is not looked at again."""
    batch = incoming.select("doc").distinct()
    buckets = bands.join(batch, "doc", "left_semi").select(*BUCKET).distinct()
    mine = batch.withColumn("mine", F.lit(True))
    return (
        join_by_key(bands, buckets, BUCKET, "left_semi")
        .join(mine, "doc", "left")
        .select("doc", *BUCKET, F.coalesce("mine", F.lit(False)).alias("is_incoming"))
    )


def batch_pairs(
    bands: DataFrame,
    incoming: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    among: bool = True,
    threshold: float = MERGE_THRESHOLD,
) -> DataFrame:
    """Candidate pairs of a batch with stored documents, and ``among`` its own: ``doc_a < doc_b``.

    The batch's rows are joined with the rows of the buckets they fall into; pairs of stored documents are
    never formed.
    """
    touched = stage(_touched(bands, incoming), "touched")
    rows = touched.drop("is_incoming")
    members = documents.join(rows.select("doc").distinct(), "doc", "left_semi")
    prefixes = stage(rare_prefixes(members, frequency, threshold), "prefixes")
    met = _matchable(stage(join_by_key(rows, different_buckets(rows), BUCKET), "crowd"), prefixes)
    marks = touched.select("doc", "is_incoming").distinct()
    met = stage(met.join(marks, "doc"), "meeting")
    stored = F.lit(False) if not among else F.col("b.is_incoming") & (F.col("a.doc") < F.col("b.doc"))
    pairs = _met(met.filter("is_incoming"), met, ~F.col("b.is_incoming") | stored, threshold)
    return stage(pairs, "met")


def lookup(
    bands: DataFrame,
    incoming: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    threshold: float = MERGE_THRESHOLD,
) -> DataFrame:
    """Candidates of the documents in ``incoming`` among all others, with the number of bands they share."""
    pairs = batch_pairs(bands, incoming, documents, frequency, False, threshold)
    batch = incoming.select("doc", F.lit(True).alias("is_incoming")).distinct()
    sided = pairs.join(batch.toDF("doc_a", "a_incoming"), "doc_a", "left")
    mates = sided.select(
        F.when(F.col("a_incoming"), F.col("doc_a")).otherwise(F.col("doc_b")).alias("incoming_doc"),
        F.when(F.col("a_incoming"), F.col("doc_b")).otherwise(F.col("doc_a")).alias("stored_doc"),
    )
    return with_shared_bands(stage(mates, "mates"), bands, "incoming_doc", "stored_doc")


# --- a stored bucket table, looked up by key -------------------------------------------------------

# Keys up to this number are written into the scan, which then opens few files and row groups.
LITERAL_KEYS = 256


def _meeting_key() -> Column:
    return F.concat_ws(":", *MEETING)


def store_index(
    bands: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    name: str,
    n_files: int = 64,
    threshold: float = MERGE_THRESHOLD,
) -> None:
    """The bucket table and the documents' rarest shingles as catalog tables, each bucketed and sorted by its key.

    ``<name>_keys`` has a row for each key that a document can be met under, ``<name>_prefixes`` one for each
    document, ``<name>_crowds`` the divided crowds, whose members meet under their rarest shingles. Sorted files with
    bloom filters let a scan for given keys pass over files and row groups, and a join on the key needs no
    shuffle of the table.
    """
    sized = stage(join_by_key(bands, bucket_sizes(bands).withColumnRenamed("n_members", "n"), BUCKET), "sized")
    prefixes = stage(rare_prefixes(documents, frequency, threshold), "prefixes")
    crowds = stage(divided_crowds(sized, prefixes), "divided")
    keys = meeting_rows(sized, crowds, prefixes).select(_meeting_key().alias("meeting_key"), "doc", "band_id")
    for part, table, key in (("keys", keys, "meeting_key"), ("prefixes", prefixes, "doc"), ("crowds", crowds, None)):
        folder = new_table_path(bands.sparkSession, f"{name}_{part}")
        writer = table if key is None else table.repartition(n_files, key)
        writer = writer.write.mode("overwrite").option("path", folder)
        if key is not None:
            writer = writer.bucketBy(n_files, key).sortBy(key).options(**{
                f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.size": str(8 << 20)
            })
        writer.saveAsTable(f"{name}_{part}")


def _rows_of(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of a bucketed table with one of the keys: found by literals if these are few, else by a join."""
    keys = keys.select(key).distinct()
    few = [row[0] for row in keys.limit(LITERAL_KEYS + 1).collect()]
    if len(few) <= LITERAL_KEYS:
        return table.filter(F.col(key).isin(few))
    return table.join(keys, key, "left_semi")


def indexed_lookup(
    keys: DataFrame, prefixes: DataFrame, name: str, threshold: float = MERGE_THRESHOLD
) -> DataFrame:
    """As ``lookup``, from the tables of ``store_index``: reads the rows of the batch's buckets only.

    ``keys`` are the batch's own rows ``doc, band_id, bucket_hash``, and ``prefixes`` its rarest shingles, both
    computed from the batch alone. Stored documents that are in the batch are not among the candidates.
    """
    spark = keys.sparkSession
    mine = meeting_rows(keys, spark.table(f"{name}_crowds"), prefixes)
    mine = stage(mine.select(F.col("doc").alias("incoming_doc"), _meeting_key().alias("meeting_key")), "batch_keys")
    table = spark.table(f"{name}_keys").withColumnRenamed("doc", "stored_doc")
    found = _rows_of(table, mine, "meeting_key").join(mine, "meeting_key")
    batch = mine.select(F.col("incoming_doc").alias("stored_doc")).distinct()
    # a bucket holds both documents once, under however many shingles they meet in it
    shared = (
        found.join(batch, "stored_doc", "left_anti")
        .groupBy("incoming_doc", "stored_doc")
        .agg(F.countDistinct("band_id").cast("int").alias("shared_bands"))
    )
    pairs = stage(shared, "shared")
    stored = _rows_of(spark.table(f"{name}_prefixes"), pairs.select(F.col("stored_doc").alias("doc")), "doc")
    known = prefixes.unionByName(stored)
    return may_match(pairs, known, "incoming_doc", "stored_doc", threshold)


def shared_buckets(pairs: DataFrame, bands: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each pair and bucket that holds both; only the bands of documents in pairs are looked at."""
    docs = pairs.select(F.col(a).alias("doc")).union(pairs.select(F.col(b).alias("doc"))).distinct()
    mine = bands.join(docs, "doc", "left_semi")
    left = pairs.join(mine.withColumnRenamed("doc", a), a)
    return left.join(mine.withColumnRenamed("doc", b), [b, *BUCKET])


def with_shared_bands(
    pairs: DataFrame, bands: DataFrame, a: str, b: str, name: str = "shared_bands"
) -> DataFrame:
    """Pairs with the number of buckets that hold both documents."""
    counts = shared_buckets(pairs.select(a, b), bands, a, b).groupBy(a, b).agg(F.count("*").alias("n"))
    return pairs.join(counts, [a, b], "left").select(
        *pairs.columns, F.coalesce("n", F.lit(0)).cast("int").alias(name)
    )


def with_kept_bands(
    pairs: DataFrame, bands: DataFrame, a: str, b: str, caps: tuple[int, ...]
) -> DataFrame:
    """Pairs with the buckets they share, and for each cap those of no more members: ``shared, kept_<cap>``."""
    met = stage(shared_buckets(pairs.select(a, b), bands, a, b), "met")
    crowds = bucket_sizes(join_by_key(bands, met.select(*BUCKET).distinct(), BUCKET, "left_semi"))
    names = ["shared", *(f"kept_{cap}" for cap in caps)]
    counts = join_by_key(met, crowds, BUCKET).groupBy(a, b).agg(
        F.count("*").alias("shared"),
        *(F.count_if(F.col("n_members") <= cap).alias(f"kept_{cap}") for cap in caps),
    )
    return pairs.join(counts, [a, b], "left").select(
        *pairs.columns, *(F.coalesce(name, F.lit(0)).cast("int").alias(name) for name in names)
    )


def pairs_within(n: Column) -> Column:
    """Pairs a group of ``n`` implies, without forming them; exact beyond 64 bits."""
    wide = n.cast("decimal(19,0)")
    return (wide * (wide - 1) / 2).cast("decimal(38,0)")


def skew_summary(bands: DataFrame, hot: int) -> DataFrame:
    """Size of the bucket table and the pairs it implies, with and without the hot buckets."""
    sizes = bucket_sizes(bands)
    cold = F.col("n_members") <= hot
    implied = pairs_within(F.col("n_members"))

    def amount(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("double")

    return sizes.agg(
        F.count("*").alias("n_buckets"),
        F.max("n_members").alias("largest_bucket"),
        amount(implied).alias("implied_pairs"),
        F.count_if(~cold).alias("hot_buckets"),
        F.max(F.when(cold, F.col("n_members"))).alias("largest_kept"),
        amount(F.when(cold, implied)).alias("implied_pairs_kept"),
    )


def largest_buckets(bands: DataFrame, top: int = 5) -> DataFrame:
    return (
        bucket_sizes(bands).orderBy(F.desc("n_members"), "band_id", "bucket_hash").limit(top)
    )
