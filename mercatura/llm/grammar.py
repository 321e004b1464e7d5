"""Token files compressed by a Re-Pair grammar.

Documents are cut by id into ranges, in ascending order; a range is a sequence of shards of bounded size. In a
shard the frequent pairs of neighbouring ids are replaced by new symbols, round after round, until no pair
is frequent. A pair never spans two documents. A shard holds its rules, the
number of ids that each rule's symbol expands to, and for each document its number of ids and the end of its
symbols; so any run of ids of a document is decoded without the ones before it.

The file format is Parquet with one row a shard, columns as in ``SHARD``. ``rules`` has two 32-bit symbols for each
rule, ``expansions`` a 32-bit length for each, ``body`` the symbols of all documents in ``width`` bytes each,
all little-endian; symbols below ``terminals`` are ids, others count the rules. Parquet is written by Spark's
commit protocol, so a lost executor leaves no partial file in the result.

A document ends with ``end_id``; a null or empty text has that id alone. Documents without an id come first.
Rows that share an id are kept in some order, each as its own document. An empty table gives an empty file.
A document is never split, so a shard may be as large as its largest document. Only the two named columns
are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercatura.llm import lookup
from mercatura.llm.common import bounded_batches
from mercatura.llm.tokens import encoder
from mercatura.session import stage

SHARD = (
    "range int, shard int, doc_ids array<long>, n_ids array<int>, body_ends array<int>, rules binary, "
    "expansions binary, body binary, width int, terminals int"
)
#: Ids of a shard, text bytes of a range, least number of ranges.
SHARD_IDS, RANGE_BYTES, LEAST_RANGES = 1 << 18, 16 << 20, 64
#: Occurrences that make a pair frequent: with fewer its rule takes more room than it saves.
FREQUENT = 4


def _winners(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the pairs at some places rank before those that overlap them; in a run of equal pairs every second."""
    k = np.arange(len(at))
    joined = np.diff(at, prepend=-2) == 1
    before = np.where(joined, np.concatenate(([-1], rank[:-1])), -1)
    after = np.where(np.append(joined[1:], False), np.append(rank[1:], -1), -1)
    offset = k - np.maximum.accumulate(np.where(rank != before, k, 0))
    return (offset % 2 == 0) & ((offset > 0) | (rank > before)) & (rank >= after)


def _replaceable(symbols: np.ndarray, at: np.ndarray, number: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each pair can be replaced: as often as it occurs, but in a run of one symbol every second time."""
    twin = np.flatnonzero(symbols[at] == symbols[at + 1])
    if not len(twin):
        return counts
    place = at[twin]
    k = np.arange(len(place))
    run = np.maximum.accumulate(np.where(np.diff(place, prepend=-2) != 1, k, 0))
    second = (k - run) % 2 == 1
    return counts - np.bincount(number[twin[second]], minlength=len(counts))


def compress(ids: np.ndarray, ends: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs of symbols), symbols and ends of documents among them, for ids and ends.

    A round counts only pairs that may be frequent: those that were so in the round before, and those with a new
    symbol, as no other pair ever occurs more often than before. The most frequent pair wins wherever it
    occurs, so rounds go on until no pair can be replaced ``FREQUENT`` times.
    """
    symbols = ids.astype(np.int64)
    last = np.zeros(len(symbols), dtype=bool)
    last[ends - 1] = True
    open_ = ~last  # places whose pair with the next symbol may be frequent
    rules: list[np.ndarray] = []
    n_rules = 0
    while True:
        at = np.flatnonzero(open_)
        pairs = symbols[at] << 32 | symbols[at + 1]
        distinct, number, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        counts = _replaceable(symbols, at, number, counts)
        often = np.flatnonzero(counts >= FREQUENT)
        if not len(often):
            break
        # rank by frequency, then by the pair, as the number of frequent pairs that come later in that order
        by_place = often[np.lexsort((-distinct[often], counts[often]))]
        place = np.full(len(distinct), -1, dtype=np.int64)
        place[by_place] = np.arange(len(by_place))
        rank = place[number]
        at, rank = at[rank >= 0], rank[rank >= 0]
        won = _winners(at, rank)
        at_won, rank_won = at[won], rank[won]
        # of the pairs that win often enough, the most frequent become rules
        uses = np.bincount(rank_won, minlength=len(by_place))
        found = np.flatnonzero(uses >= FREQUENT)[::-1]
        symbol = np.full(len(by_place), -1, dtype=np.int64)
        symbol[found] = terminals + n_rules + np.arange(len(found))
        rules.append(distinct[by_place[found]])
        n_rules += len(found)
        made = symbol[rank_won]
        at_won, made = at_won[made >= 0], made[made >= 0]
        open_[:] = False
        open_[at] = True
        symbols[at_won] = made
        last[at_won] = last[at_won + 1]
        open_[at_won] = True
        open_[np.maximum(at_won - 1, 0)] = True  # the symbol before; if that goes, so does its mark
        keep = np.ones(len(symbols), dtype=bool)
        keep[at_won + 1] = False
        # a symbol in front of a replaced pair may itself be the new symbol of the pair before
        after = np.flatnonzero(~keep[at_won - 1] & (at_won >= 2))
        open_[at_won[after] - 2] = True
        symbols, last, open_ = symbols[keep], last[keep], open_[keep]
        open_ &= ~last
    made = np.concatenate(rules) if rules else np.zeros(0, np.int64)
    return np.stack((made >> 32, made & 0xFFFFFFFF), axis=1), symbols, np.flatnonzero(last) + 1


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each rule's symbol stands for; a rule uses symbols of earlier rules only."""
    lengths = np.ones(len(rules), dtype=np.int64)
    parts = [np.where(rules[:, side] >= terminals, rules[:, side] - terminals, -1) for side in (0, 1)]
    while True:
        new = sum(np.where(p >= 0, lengths[np.maximum(p, 0)], 1) for p in parts) if len(rules) else lengths
        if np.array_equal(new, lengths):
            return lengths
        lengths = new


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that symbols stand for."""
    while True:
        open_ = symbols >= terminals
        if not open_.any():
            return symbols
        sizes = 1 + open_
        place = np.cumsum(sizes) - sizes
        longer = np.empty(int(sizes.sum()), dtype=np.int64)
        longer[place[~open_]] = symbols[~open_]
        both = rules[symbols[open_] - terminals]
        longer[place[open_]], longer[place[open_] + 1] = both[:, 0], both[:, 1]
        symbols = longer


class Expansions:
    """The ids of every rule's symbol, one after the other; rules are filled in by depth, those of a depth at once."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, terminals: int):
        self.terminals, self.lengths = terminals, lengths
        self.starts = np.cumsum(lengths) - lengths
        self.flat = np.empty(int(lengths.sum()), dtype=np.int64)
        depth = np.zeros(len(rules), dtype=np.int64)
        inner = [np.where(rules[:, side] >= terminals, rules[:, side] - terminals, -1) for side in (0, 1)]
        while len(rules):
            new = 1 + np.maximum(*(np.where(part >= 0, depth[part], 0) for part in inner))
            if np.array_equal(new, depth):
                break
            depth = new
        for level in range(1, int(depth.max(initial=0)) + 1):
            some = np.flatnonzero(depth == level)
            self.flat[_ranges(self.starts[some], lengths[some])] = self.of(rules[some].reshape(-1))

    def of(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that symbols stand for."""
        made = symbols >= self.terminals
        sizes = np.ones(len(symbols), dtype=np.int64)
        sizes[made] = self.lengths[symbols[made] - self.terminals]
        starts = np.zeros(len(symbols), dtype=np.int64)
        starts[made] = self.starts[symbols[made] - self.terminals]
        found = self.flat.take(_ranges(starts, sizes)) if len(self.flat) else np.empty(len(symbols), np.int64)
        found[(np.cumsum(sizes) - sizes)[~made]] = symbols[~made]
        return found


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


#: Beyond so many times its ids, a shard's expansions are not spelled out.
SPELLED = 8


class Shard:
    """A shard as read back."""

    def __init__(self, row: dict):
        self.terminals = row["terminals"]
        self.doc_ids, self.n_ids = row["doc_ids"], np.array(row["n_ids"], dtype=np.int64)
        self.rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2).astype(np.int64)
        self.expansions = np.frombuffer(row["expansions"], dtype="<u4").astype(np.int64)
        self.symbols = np.frombuffer(row["body"], dtype=f"<u{row['width']}").astype(np.int64)
        self.ends = np.array(row["body_ends"], dtype=np.int64)

    def documents(self) -> Iterator[np.ndarray]:
        """Ids of each document."""
        if self.expansions.sum() <= SPELLED * self.n_ids.sum():
            ids = Expansions(self.rules, self.expansions, self.terminals).of(self.symbols).astype("<u4")
        else:
            ids = expand(self.symbols, self.rules, self.terminals).astype("<u4")
        ends = np.cumsum(self.n_ids)
        for a, b in zip(ends - self.n_ids, ends, strict=True):
            yield ids[a:b]

    def read(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of one document; only symbols that reach into that run are expanded."""
        first = self.ends[document - 1] if document else 0
        symbols = self.symbols[first : self.ends[document]]
        lengths = np.ones(len(symbols), dtype=np.int64)
        made = symbols >= self.terminals
        lengths[made] = self.expansions[symbols[made] - self.terminals]
        upto = np.cumsum(lengths)
        a, b = np.searchsorted(upto, start, side="right"), np.searchsorted(upto, stop, side="left") + 1
        skipped = int(upto[a - 1]) if a else 0
        found = expand(symbols[a:b], self.rules, self.terminals)
        return found[start - skipped : stop - skipped].astype("<u4")


def _shard_row(part: int, number: int, doc_ids: list, texts: list[bytes], terminals: int) -> dict:
    ids = np.frombuffer(b"".join(texts), dtype="<u4")
    n_ids = np.array([len(t) // 4 for t in texts])
    rules, symbols, ends = compress(ids, np.cumsum(n_ids), terminals)
    width = 2 if terminals + len(rules) <= 1 << 16 else 4
    return {
        "range": part, "shard": number, "doc_ids": doc_ids, "n_ids": n_ids.tolist(), "body_ends": ends.tolist(),
        "rules": rules.astype("<u4").tobytes(),
        "expansions": expansion_lengths(rules, terminals).astype("<u4").tobytes(),
        "body": symbols.astype(f"<u{width}").tobytes(), "width": width, "terminals": terminals,
    }


_ARROW = pa.schema(
    [
        ("range", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("n_ids", pa.list_(pa.int32())), ("body_ends", pa.list_(pa.int32())), ("rules", pa.binary()),
        ("expansions", pa.binary()), ("body", pa.binary()), ("width", pa.int32()), ("terminals", pa.int32()),
    ]
)


def write_tokens(
    docs: DataFrame, path: str, definition: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode all documents and write their ids in ascending order of the document id."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = max(LEAST_RANGES, -(-lookup.text_bytes(texts) // RANGE_BYTES))
    shared = spark.sparkContext.broadcast(definition)
    end = end_id.to_bytes(4, "little")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value)
        terminals = max(encode.whole.get_vocab_size(with_added_tokens=True), end_id + 1)
        part, number, doc_ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0
        row = lambda: pa.RecordBatch.from_pylist(
            [_shard_row(part, number, doc_ids, held, terminals)], _ARROW
        )
        for batch in batches:
            found = encode.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                doc_ids.append(doc_id)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= SHARD_IDS:
                    yield row()
                    number, doc_ids, held, size = number + 1, [], [], 0
        if doc_ids:
            yield row()

    ordered = texts.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(shards, SHARD).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written file: doc_id, start (ids of all documents before), ids (4 bytes each)."""
    shards = spark.read.schema(SHARD).parquet(path).withColumn(
        "size", F.aggregate("n_ids", F.lit(0).cast("long"), lambda total, x: total + x)
    )
    sizes = shards.select("range", "shard", "size")
    # one row for each range is summed up in order, then the shards within each range
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.groupBy("range").agg(F.sum("size").alias("total")).select(
        "range", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(before, "range").select(
        "range", "shard", (F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))).alias("start")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "start": pa.array(row["start"] + np.cumsum(shard.n_ids) - shard.n_ids, pa.int64()),
                        "ids": pa.array([x.tobytes() for x in shard.documents()], pa.binary()),
                    }
                )

    return shards.drop("size").join(stage(starts, "starts"), ["range", "shard"]).mapInArrow(
        decode, "doc_id long, start long, ids binary"
    )
