"""Jaccard scores of text pairs over whole Arrow batches.

They equal ``set_jaccard`` of the column expressions in ``mercatura.functions.text``, which makes a string of every
shingle of both texts for every pair. What a task needs is defined inside the functions, so workers need not find
this package.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

WORD_PAIR = r"\b(?=([a-z0-9]+ [a-z0-9]+))[a-z0-9]+"


def _pairs_of():
    """A function from a cleaned text to its distinct adjacent word pairs, in order."""
    pattern = re.compile(WORD_PAIR, re.ASCII)

    def pairs(text: str) -> list[str]:
        if " " not in text:
            return [text] if text else []
        words = text.split(" ")
        # split words are those of the pattern where only letters, digits and single blanks occur
        if "" not in words and text.isascii() and (joined := "".join(words)).isalnum() and joined == joined.lower():
            return list(dict.fromkeys(map(" ".join, zip(words, words[1:]))))
        return list(dict.fromkeys(pattern.findall(text)))

    return pairs


def pair_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of the word pairs of two cleaned texts; 0 when either has none, else null when either is null."""
    pairs = _pairs_of()

    def score(left: pa.Array, right: pa.Array) -> pa.Array:
        known: dict[str, frozenset] = {}
        scores = []
        for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True):
            if x is None or y is None:
                known_text = x if y is None else y
                scores.append(None if known_text is None or pairs(known_text) else 0.0)
                continue
            first = known.get(x)
            if first is None:
                if len(known) >= 64:
                    known.clear()
                first = known[x] = frozenset(pairs(x))
            second = frozenset(pairs(y))
            shared = len(first & second)
            scores.append(shared / (len(first) + len(second) - shared) if first and second else 0.0)
        return pa.array(scores, pa.float64())

    return _udf(score, "double", a, b)


def keyed_jaccard(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """As ``pair_jaccard``, with the word pairs of a text made once for all pairs under a key: ``doc_a, doc_b, jaccard``.

    ``rows`` are texts ``key, doc, text`` and pairs ``key, doc_a, doc_b``, each with nulls for the other's columns;
    those of a key are in one partition in a row, texts first. A pair without the text of a side gives no row.
    """
    pairs = _pairs_of()

    def score(first: frozenset | None, second: frozenset | None) -> float | None:
        if first is None or second is None:
            known = second if first is None else first
            return None if known is None or known else 0.0
        shared = len(first & second)
        return shared / (len(first) + len(second) - shared) if first and second else 0.0

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            out = ([], [], [])
            columns = (batch[name].to_pylist() for name in ("key", "doc", "text", "doc_a", "doc_b"))
            for at, doc, text, a, b in zip(*columns, strict=True):
                if at != key:
                    key, held = at, {}
                if doc is not None:
                    held.setdefault(doc, []).append(None if text is None else frozenset(pairs(text)))
                    continue
                for first in held.get(a, ()):
                    for second in held.get(b, ()):
                        for column, value in zip(out, (a, b, score(first, second)), strict=True):
                            column.append(value)
            if out[0]:
                arrays = [pa.array(values, batch[name].type) for values, name in zip(out, ("doc_a", "doc_b"))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(out[2], pa.float64())], schema.names)

    return rows.mapInArrow(scores, schema)


def _kgram_scores(k: int, keep_short: bool):
    """A function from two lists of texts to the scores of ``kgram_jaccard``."""
    bits = 63 // k

    def grams(text: str, narrow: bool) -> np.ndarray | frozenset:
        if len(text) < k:
            return frozenset([text] if text and keep_short else [])
        if not narrow:
            return frozenset(text[i : i + k] for i in range(len(text) - k + 1))
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        key = codes[: len(codes) - k + 1].copy()
        for i in range(1, k):
            key <<= np.uint64(bits)
            key |= codes[i : len(codes) - k + 1 + i]
        key.sort()
        return key[np.flatnonzero(np.append(True, key[1:] != key[:-1]))]

    def score(left: list, right: list) -> list:
        known: dict[tuple, np.ndarray | frozenset] = {}
        scores = []
        for x, y in zip(left, right, strict=True):
            if x is None or y is None:
                known_text = x if y is None else y
                scores.append(None if known_text is None or len(grams(known_text, False)) else 0.0)
                continue
            # a short text has no run in common with a longer one
            narrow = max(max(x, default=""), max(y, default="")) < chr(min(1 << bits, 0x10FFFF))
            first = known.get((x, narrow))
            if first is None:
                if len(known) >= 64:
                    known.clear()
                first = known[x, narrow] = grams(x, narrow)
            second = grams(y, narrow)
            if isinstance(first, frozenset) or isinstance(second, frozenset):
                shared = len(first & second) if type(first) is type(second) else 0
            else:
                both = np.concatenate([first, second])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
            total = len(first) + len(second) - shared
            scores.append(shared / total if len(first) and len(second) else 0.0)
        return scores

    return score


def kgram_jaccard(a: Column, b: Column, k: int, keep_short: bool) -> Column:
    """Jaccard of the runs of ``k`` characters of two texts, as ``text.char_kgrams`` has them.

    A run is one whole number where its characters have few enough bits, which keeps the comparison exact.
    """
    of_lists = _kgram_scores(k, keep_short)

    def score(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(of_lists(left.to_pylist(), right.to_pylist()), pa.float64())

    return _udf(score, "double", a, b)


def keyed_kgram_jaccard(rows: DataFrame, schema: T.StructType, k: int, keep_short: bool) -> DataFrame:
    """Scores of ``kgram_jaccard`` for rows as ``keyed_jaccard`` has them."""
    of_lists = _kgram_scores(k, keep_short)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            docs, texts = ([], []), ([], [])
            columns = (batch[name].to_pylist() for name in ("key", "doc", "text", "doc_a", "doc_b"))
            for at, doc, text, a, b in zip(*columns, strict=True):
                if at != key:
                    key, held = at, {}
                if doc is not None:
                    held.setdefault(doc, []).append(text)
                    continue
                for first in held.get(a, ()):
                    for second in held.get(b, ()):
                        for column, value in zip((*docs, *texts), (a, b, first, second), strict=True):
                            column.append(value)
            if docs[0]:
                arrays = [pa.array(values, batch[name].type) for values, name in zip(docs, ("doc_a", "doc_b"))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(of_lists(*texts), pa.float64())], schema.names)

    return rows.mapInArrow(scores, schema)


def _udf(function, kind: str, *columns: Column) -> Column:
    return F.arrow_udf(function, kind)(*columns)
