"""Removal of word sequences that repeat between documents, by level-wise doubling.

Windows of a short length are looked up first; only documents' places where a window repeats are looked up
again at twice the length, up to the target length or until no candidates survive. At the first level one
window stands for each window of the next level that contains it: the one with the smallest hash among those
inside, which equal windows share. So a level asks about a fraction of all places and the next only about
places that can still repeat.

Words are maximal runs of characters other than blank, tab and line or page breaks. Each word covered by a
window of ``size`` words that also starts in a document with a smaller id is removed; windows are judged on
the input. A null or empty text has no words. Rows without an id come after all ids and are not smaller than
one another; rows that share an id don't count as smaller either. An empty table gives an empty table. Only
the two named columns are read. Windows are compared by 64-bit hashes, at each level anew.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.llm import lookup, words
from mercatura.llm.common import bounded_batches

RESULT = "doc_id long, n_words long, n_removed long, kept string"
NO_ID = np.iinfo(np.int64).max


def levels(size: int, first: int) -> list[int]:
    """Window lengths, each at most twice the one before, ending at ``size``."""
    found = [size]
    while found[0] > first:
        found.insert(0, -(-found[0] // 2))
    return found


def smallest_inside(hashes: np.ndarray, short: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``size`` words the position of the smallest short window inside it."""
    n, width = len(hashes) - (size - short), size - short + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, place = hashes[:n].copy(), np.arange(n)
    for k in range(1, width):
        smaller = hashes[k : k + n] < best
        best[smaller] = hashes[k : k + n][smaller]
        place[smaller] = np.flatnonzero(smaller) + k
    return place, best


class Block:
    """The documents of one block, and the hashes of their windows."""

    def __init__(self, table: pa.Table):
        data, offsets = words.utf8(table["text"].cast(pa.large_string()).combine_chunks())
        self.words = words.split(data, offsets)
        self.hashes = words.hashes(self.words)
        self.ids = table["doc_id"].fill_null(NO_ID).to_numpy()
        self.doc = words.owners(self.words.first)

    def inside(self, size: int) -> np.ndarray:
        """Where a window of ``size`` words of one document starts."""
        n = max(0, len(self.doc) - size + 1)
        return self.doc[:n] == self.doc[len(self.doc) - n :] if n else np.zeros(0, bool)

    def windows(self, size: int) -> np.ndarray:
        return words.windows(self.hashes, size)

    def tops(self, short: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of ``size`` words, and the hash of the short window that stands for each.

        The smallest hashes crowd at one end of the range that buckets are cut from, so they are mixed again.
        """
        _, best = smallest_inside(self.windows(short), short, size)
        starts = np.flatnonzero(self.inside(size))
        return starts, words.mix(best[starts])

    def smallest_ids(self, starts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct values, the smallest and the largest id that each occurs with, and each value's number."""
        distinct, number = np.unique(values, return_inverse=True)
        low = np.full(len(distinct), NO_ID)
        high = np.full(len(distinct), np.iinfo(np.int64).min)
        ids = self.ids[self.doc[starts]]
        np.minimum.at(low, number, ids)
        np.maximum.at(high, number, ids)
        return distinct, low, high, number


def _surviving(block: Block, sizes: list[int], replies: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of windows of the last size whose shorter windows repeat, level by level.

    ``replies`` has the answers for all sizes but the last.
    """
    size = sizes[-1]
    if len(sizes) == 1:
        starts = np.flatnonzero(block.inside(size))
        return starts, block.windows(size)[starts]
    alive = None
    for level, found in enumerate(replies):
        short = sizes[level]
        longer = sizes[level + 1]
        if level == 0:
            starts, values = block.tops(short, longer)
        else:
            starts, values = alive, block.windows(short)[alive]
        distinct, low, high, number = block.smallest_ids(starts, values)
        good = (lookup.member(distinct, found) | (low < high))[number]
        starts = starts[good]
        if level:
            # a window of the longer size starts where both of its halves survive
            held = np.zeros(len(block.doc) + longer, dtype=bool)
            held[starts] = True
            starts = np.flatnonzero(block.inside(longer))
            starts = starts[held[starts] & held[starts + longer - short]]
        alive = starts
    return alive, block.windows(size)[alive]


def remove_repeats(
    docs: DataFrame, size: int = 13, first: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's word count, number of words removed, and kept words joined by blanks."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_blocks, bits = lookup.sizes(lookup.text_bytes(texts))
    bounds = lookup.ranges(texts, "doc_id", n_blocks)
    blocks = texts.withColumn("block", lookup.range_block(F.col("doc_id"), bounds))
    sizes = levels(size, first)

    def ask_for(number: int, values: np.ndarray) -> pa.Table:
        return lookup.request_table(lookup.requests(number, np.unique(values), bits))

    def first_requests(table: pa.Table) -> pa.Table:
        block = Block(table)
        if len(sizes) == 1:
            _, values = _surviving(block, sizes, [])
        else:
            _, values = block.tops(sizes[0], sizes[1])
        return ask_for(table["block"][0].as_py(), values)

    def next_requests(level: int):
        def build(key, table: pa.Table, answers: pa.Table) -> pa.Table:
            if not table.num_rows:
                return lookup.request_table([])
            block = Block(table)
            _, values = _surviving(block, sizes[: level + 1], _by_level(answers, level))
            return ask_for(key[0].as_py(), values)

        return build

    def finish(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        return _result(Block(table), sizes, _by_level(answers, len(sizes)), table)

    def labelled(reply: DataFrame, level: int) -> DataFrame:
        return reply.withColumn("level", F.lit(level))

    by_block = blocks.groupBy("block")
    asked = by_block.applyInArrow(first_requests, lookup.REQUEST)
    answers = None
    for level in range(len(sizes)):
        last = level == len(sizes) - 1
        reply = labelled(lookup.ask(asked, "earlier" if last else "elsewhere"), level)
        answers = reply if answers is None else answers.unionByName(reply)
        if not last:
            asked = by_block.cogroup(answers.groupBy("block")).applyInArrow(
                next_requests(level + 1), lookup.REQUEST
            )
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(finish, RESULT)


def _by_level(answers: pa.Table, n: int) -> list[np.ndarray]:
    """Sorted answers of each of the first n levels."""
    level = answers["level"].to_numpy() if answers.num_rows else np.zeros(0, np.int32)
    return [lookup.replied(answers.filter(pa.array(level == k)))[0] for k in range(n)]


def _result(block: Block, sizes: list[int], replies: list[np.ndarray], table: pa.Table) -> pa.Table:
    size = sizes[-1]
    starts, values = _surviving(block, sizes, replies[:-1])
    distinct, low, _, number = block.smallest_ids(starts, values)
    earlier = lookup.member(distinct, replies[-1])[number]
    earlier |= low[number] < block.ids[block.doc[starts]]
    cover = np.zeros(len(block.doc) + 1, dtype=np.int64)
    cover[starts[earlier]] += 1
    cover[starts[earlier] + size] -= 1
    removed = np.cumsum(cover)[:-1] > 0
    found = block.words
    # keep the bytes of kept words, and the separator behind each as a blank
    kept = np.flatnonzero(~removed)
    text_end = np.zeros(len(found.data) + 1, dtype=bool)
    text_end[found.offsets] = True
    begin, end = found.begin[kept], found.end[kept]
    inner = ~text_end[end]
    change = np.zeros(len(found.data) + 1, dtype=np.int8)
    change[begin] += 1
    change -= np.bincount(end + inner, minlength=len(change)).astype(np.int8)
    keep = np.cumsum(change[:-1], dtype=np.int8) > 0
    data = found.data.copy()
    data[end[inner]] = 0x20
    texts = [
        data[a:b][keep[a:b]].tobytes().rstrip(b" ").decode()
        for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True)
    ]
    removed_upto = np.concatenate(([0], np.cumsum(removed)))
    n_removed = removed_upto[found.first[1:]] - removed_upto[found.first[:-1]]
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "n_words": pa.array(np.diff(found.first), pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(texts, pa.string()),
        }
    )
