"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie. Where matching fails in a node, a failure link leads to the node that the rest of the
text matched so far reaches after its longest pieces are split off; how many pieces that splits off is computed
beforehand. So a word is read once, byte by byte, and the number of its pieces is a sum of precomputed counts;
no piece is built. The count equals that of taking the longest piece of the vocabulary again and again.

A word of which the vocabulary cannot make up some part counts as one unknown piece. Words are maximal runs of
characters that are not white space. A null, empty or blank text has none. Rows that share an id are counted
one by one; an empty table gives an empty table. Only the two named columns are read. The vocabulary is
broadcast; a vocabulary beyond ``MAX_BYTES`` is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches
from mercatura.llm.tokens import _byte_letters

MAX_BYTES = 64 << 20
#: Words whose counts a worker keeps; a full table is emptied.
TABLE = 500_000
NONE = -1


class Automaton:
    """``initial`` pieces start a word, ``continuing`` pieces go on with it."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes]):
        self.child: dict[int, int] = {}  # by node * 256 + byte
        self.piece = [False, False]
        self.start, self.inner = 0, 1  # roots: nothing read, and just behind a piece
        order: list[tuple[int, int, int]] = []  # parent, byte, node
        for root, pieces in ((self.start, initial), (self.inner, continuing)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.child:
                        self.child[key] = len(self.piece)
                        order.append((node, byte, len(self.piece)))
                        self.piece.append(False)
                    node = self.child[key]
                self.piece[node] |= node != root
        self.fail = [NONE] * len(self.piece)
        self.popped = [0] * len(self.piece)
        self._link(order)

    def _link(self, order: list[tuple[int, int, int]]) -> None:
        """Failure links and popped counts, shorter prefixes first."""
        depth = {self.start: 0, self.inner: 0}
        for parent, _, node in order:
            depth[node] = depth[parent] + 1
        for parent, byte, node in sorted(order, key=lambda x: depth[x[2]]):
            if self.piece[node]:
                self.fail[node], self.popped[node] = self.inner, 1
                continue
            at, count = self.fail[parent], self.popped[parent]
            while at != NONE and (at << 8 | byte) not in self.child:
                count += self.popped[at]
                at = self.fail[at]
            if at != NONE:
                self.fail[node], self.popped[node] = self.child[at << 8 | byte], count

    def count(self, word: bytes) -> int:
        """Number of pieces of a word; 1 if it has no division."""
        child, fail, popped = self.child, self.fail, self.popped
        node, total = self.start, 0
        for byte in word:
            while (to := child.get(node << 8 | byte)) is None:
                total += popped[node]
                node = fail[node]
                if node == NONE:
                    return 1
            node = to
        while node != self.inner:
            total += popped[node]
            node = fail[node]
            if node == NONE:
                return 1 if word else 0
        return total


def byte_level_pieces(definition: str) -> list[bytes]:
    """The vocabulary of a byte-level tokenizer file as byte strings, without its special tokens."""
    parts = json.loads(definition)
    special = {x["content"] for x in parts.get("added_tokens", [])}
    byte_of = {letter: byte for byte, letter in _byte_letters().items()}
    return [
        bytes(byte_of[c] for c in token) for token in parts["model"]["vocab"] if token not in special
    ]


class Counter:
    """Counts of words, those met before from a table."""

    def __init__(self, automaton: Automaton, mark: bytes):
        self.automaton, self.mark, self.known = automaton, mark, {}

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and pieces of a text."""
        words = (text or "").split()
        known = self.known
        if len(known) > TABLE:
            known.clear()
        total = 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = known[word] = self.automaton.count(self.mark + word.encode())
            total += n
        return len(words), total


@cache
def counter(pieces: tuple[bytes, ...], continuing: tuple[bytes, ...] | None, mark: bytes) -> Counter:
    return Counter(Automaton(pieces, pieces if continuing is None else continuing), mark)


def count_pieces(
    docs: DataFrame,
    initial: list[bytes],
    continuing: list[bytes] | None = None,
    mark: bytes = b"",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Words and word pieces of every text: doc_id, n_words, n_tokens; without a shuffle.

    ``continuing`` is the vocabulary behind a word's first piece, by default the same; ``mark`` is written
    before each word, for vocabularies that mark a word's start.
    """
    size = sum(map(len, initial)) + sum(map(len, continuing or ()))
    if size > MAX_BYTES:
        raise ValueError(f"the vocabulary has {size} bytes; at most {MAX_BYTES} are broadcast")
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(
        (tuple(initial), None if continuing is None else tuple(continuing), mark)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(*shared.value).count
        for batch in batches:
            found = [of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))],
                ["doc_id", "n_words", "n_tokens"],
            )

    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(count, f"doc_id {kind}, n_words long, n_tokens long")
