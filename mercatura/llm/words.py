"""Words of whole batches of texts as 64-bit hashes, computed on the UTF-8 bytes with array operations.

A word is a maximal run of bytes other than blank, tab and the line and page breaks (0x09-0x0D), which never
occur inside a longer UTF-8 sequence. The hash of a word depends on its bytes only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; a longer word is hashed whole.
CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass(slots=True)
class Words:
    """``begin`` and ``end`` are byte positions in ``data``; the words of text i are ``first[i]:first[i+1]``."""

    data: np.ndarray
    offsets: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values(fold_case: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold_case:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    powers = [np.full(n, base, dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, _MASK + 1))]
    for p in powers:
        p[0] = 1
        np.multiply.accumulate(p, out=p)
    return tuple(powers)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, nulls as empty texts."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text starts or ends here
    edge[offsets] = True
    before = np.concatenate(([False], inside))[:-1]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, offsets, begin, end, np.searchsorted(begin, offsets))


def hashes(words: Words, fold_case: bool = False) -> np.ndarray:
    """A hash for each word: a polynomial over its bytes, shifted to position 0 and mixed."""
    out = np.empty(len(words.begin), dtype=np.uint64)
    values = _byte_values(fold_case)
    at = 0
    while at < len(out):
        base = words.begin[at]
        until = max(at + 1, int(np.searchsorted(words.end, base + CHUNK, side="right")))
        begin, end = words.begin[at:until] - base, words.end[at:until] - base
        size = int(end[-1])
        power, inverse = _powers(CHUNK + 1 if size <= CHUNK else 1 << size.bit_length())
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values[words.data[base : base + size]] * power[:size], out=sums[1:])
        out[at:until] = (sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64)
        at = until
    return mix(out)


def windows(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the window of ``size`` words that starts at each word of one sequence, in order."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + word_hashes[k : k + n]
    return mix(total)


def owners(first: np.ndarray) -> np.ndarray:
    """For each word the text that it is in."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
