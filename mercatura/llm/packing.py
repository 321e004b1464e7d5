"""Packing by minimum bin slack.

Each task packs the documents it reads, without a shuffle. A document's full runs of ``capacity`` ids are
sequences of their own; what remains waits in a window. When a window is full, sequences are filled from it one
by one: the longest remainder first, then, by a subset-sum table over the remaining lengths (a bit set of the
sums that can be reached, for each length one), the multiset of lengths that comes closest to the capacity,
whose counts are traced back. A sequence that stays short is filled by cutting a remainder. The last ids of
a task, less than one sequence, go to sequences whose sizes are powers of two, which need no padding. So no
sequence is padded at all.

Positions are the ids before a piece in its document and in its sequence. A document ends with ``end_id``; a null
or empty text has that id alone. Rows that share an id are documents of their own. An empty table gives an
empty table. Only the two named columns are read. Sequence ids are unique, not consecutive: the task's number
and a counter. A rerun of a lost task reads the same rows and so gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches
from mercatura.llm.tokens import encoder

CAPACITY = 4096
#: Ids that wait in a task for packing.
WINDOW = 1 << 19
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "ids binary"
)


@dataclass(slots=True)
class Piece:
    """Ids ``start`` and on of a document; ``ids`` are 4 bytes each."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * n]),
            Piece(self.doc_id, self.start + n, self.doc_tokens, self.ids[4 * n :]),
        )


def closest_multiset(lengths: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill the room best. ``lengths`` has the number there are of each length.

    Lengths are added one after the other until the room can be filled exactly.
    """
    within = (1 << (room + 1)) - 1
    tables = [1]  # bit s is set if the sum s can be reached
    order = [x for x in sorted(lengths, reverse=True) if x <= room]
    for length in order:
        reached = tables[-1]
        for _ in range(min(lengths[length], room // length)):
            more = tables[-1] | (reached << length) & within
            if more == reached:
                break
            reached = more
        tables.append(reached)
        if reached >> room & 1:
            break
    total = tables[-1].bit_length() - 1
    chosen: dict[int, int] = {}
    for length, before in zip(reversed(order[: len(tables) - 1]), reversed(tables[:-1]), strict=True):
        while not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


@dataclass(slots=True)
class Window:
    """Remainders that wait, by length."""

    waiting: dict[int, list[Piece]] = field(default_factory=dict)
    total: int = 0

    def put(self, piece: Piece) -> None:
        if len(piece):
            self.waiting.setdefault(len(piece), []).append(piece)
            self.total += len(piece)

    def take(self, length: int) -> Piece:
        found = self.waiting[length].pop()
        if not self.waiting[length]:
            del self.waiting[length]
        self.total -= length
        return found

    def sequence(self, capacity: int) -> list[Piece]:
        """A full sequence; there must be ids enough for one."""
        found = [self.take(max(self.waiting))]
        room = capacity - len(found[0])
        counts = {length: len(pieces) for length, pieces in self.waiting.items()}
        for length, n in closest_multiset(counts, room).items():
            found += [self.take(length) for _ in range(n)]
            room -= n * length
        while room:
            piece, rest = self.take(max(self.waiting)), None
            if len(piece) > room:
                piece, rest = piece.cut(room)
                self.put(rest)
            found.append(piece)
            room -= len(piece)
        return found

    def powers_of_two(self) -> Iterator[list[Piece]]:
        """What is left, in sequences of sizes that are powers of two, the largest first."""
        while self.total:
            size, longest = 1 << (self.total.bit_length() - 1), max(self.waiting)
            if longest <= size:
                yield self.sequence(size)
            else:
                piece, rest = self.take(longest).cut(size)
                self.put(rest)
                yield [piece]


def sequences(documents: Iterator[Piece], capacity: int = CAPACITY) -> Iterator[list[Piece]]:
    """Sequences of pieces; all documents together, in windows of bounded size."""
    window = Window()
    for piece in documents:
        while len(piece) >= capacity:
            full, piece = piece.cut(capacity)
            yield [full]
        window.put(piece)
        if window.total >= WINDOW:
            while window.total >= WINDOW // 8 + capacity:
                yield window.sequence(capacity)
    while window.total >= capacity:
        yield window.sequence(capacity)
    yield from window.powers_of_two()


def pack(
    docs: DataFrame,
    definition: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents, each with its place in its document and its sequence, and its ids."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(definition)
    end = end_id.to_bytes(4, "little")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        encode = encoder(shared.value).encode
        for batch in batches:
            ids = encode(batch.column("text").to_pylist())
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                yield Piece(doc_id, 0, len(one) // 4 + 1, one + end)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(name, pa.int64()) for name in PIECES.replace(",", "").split()[:-2:2]] + [("ids", pa.binary())]
        )
        task = TaskContext.get().partitionId() << 40
        rows, held = [], 0
        for number, sequence in enumerate(sequences(documents(batches), capacity)):
            offset = 0
            for x in sequence:
                rows.append(
                    (x.doc_id, x.start, len(x), zlib.crc32(x.ids), x.doc_tokens, task + number, offset,
                     x.ids if keep_ids else None)
                )
                offset += len(x)
            held += offset
            if held >= WINDOW:
                yield _batch(rows, schema)
                rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    return texts.mapInArrow(fill, PIECES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
    )
