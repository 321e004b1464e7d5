"""Measures of the lines of whole batches of texts, computed on the UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from mercatura.llm import words

_LOWER, _UPPER, _DIGIT, _SPACE, _SENTENCE, _SYMBOL, _NEWLINE, _INNER = range(8)
#: Words of a window whose repetition within a text is measured.
WINDOW = 4
NAMES = (
    "length", "upper", "digits", "blanks", "sentence signs", "symbols", "words", "word length", "same as before",
    "first met", "repeated windows", "signs behind words", "bare signs", "closed",
)


def _classes() -> np.ndarray:
    """Class of each byte; bytes of longer characters count once, as letters."""
    found = np.full(256, _SYMBOL, dtype=np.uint8)
    found[0x61:0x7B] = _LOWER
    found[0x41:0x5B] = _UPPER
    found[0x30:0x3A] = _DIGIT
    found[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _SPACE
    found[list(b".,;:'\"()?!-")] = _SENTENCE
    found[0x0A] = _NEWLINE
    found[0x80:0xC0] = _INNER
    found[0xC0:] = _LOWER
    return found


_CLASS = _classes()


@dataclass(slots=True)
class Lines:
    """``values``: a row of measures for each line; the lines of text i are ``first[i]:first[i+1]``."""

    values: np.ndarray
    chars: np.ndarray
    first: np.ndarray


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of flags over the runs that start at ``first`` and end where the next one starts."""
    upto = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (upto[first[1:]] - upto[first[:-1]]).astype(np.float64)


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key occurs more than once, and whether it is the first of its kind."""
    _, index, number, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    first = np.zeros(len(keys), dtype=bool)
    first[index] = True
    return counts[number] > 1, first


def measure(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines are cut at line feeds; a text has one line more than it has line feeds."""
    kinds = _CLASS[data]
    breaks = np.flatnonzero(kinds == _NEWLINE)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    first_line = np.arange(len(offsets)) + np.searchsorted(breaks, offsets)
    edges = np.append(starts, len(data))
    count = lambda kind: _sums(kinds == kind, edges)
    chars = np.diff(edges) - count(_INNER) - count(_NEWLINE)
    some = np.maximum(chars, 1)
    lower, upper = count(_LOWER), count(_UPPER)

    found = words.split(data, offsets)
    hashed = words.hashes(found)
    text = words.owners(found.first)
    line_first = np.searchsorted(found.begin, edges)
    n_words = np.diff(line_first).astype(np.float64)
    some_words = np.maximum(n_words, 1)
    same_text = text[1:] == text[:-1]
    before = np.concatenate(([False], (hashed[1:] == hashed[:-1]) & same_text)) if len(text) else np.zeros(0, bool)
    owner = text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    _, first_met = _repeats(words.mix(hashed + owner))
    covered = np.zeros(len(hashed) + 1, dtype=np.int64)
    inside = np.flatnonzero(text[: max(0, len(text) - WINDOW + 1)] == text[WINDOW - 1 :])
    again, _ = _repeats(words.mix(words.windows(hashed, WINDOW)[inside] + owner[inside]))
    covered[inside[again]] += 1
    covered[inside[again] + WINDOW] -= 1
    in_repeat = np.cumsum(covered)[:-1] > 0
    sign = (kinds == _SENTENCE) | (kinds == _SYMBOL)
    long = found.end - found.begin > 1
    double = np.zeros(len(hashed), dtype=bool)
    if len(hashed):
        double = long & sign[found.end - 1] & sign[found.end - 2]
    signs_upto = np.concatenate(([0], np.cumsum(sign, dtype=np.int64)))
    bare = signs_upto[found.end] - signs_upto[found.begin] == found.end - found.begin
    closed = np.zeros(len(starts))
    has = line_first[1:] > line_first[:-1]
    last = found.end[line_first[1:][has] - 1] - 1
    closed[has] = kinds[last] == _SENTENCE
    values = np.stack(
        [
            np.log1p(chars), upper / np.maximum(lower + upper, 1), count(_DIGIT) / some, count(_SPACE) / some,
            count(_SENTENCE) / some, count(_SYMBOL) / some, np.log1p(n_words),
            _sums(found.end - found.begin, line_first) / some_words, _sums(before, line_first) / some_words,
            _sums(first_met, line_first) / some_words, _sums(in_repeat, line_first) / some_words,
            _sums(double, line_first) / some_words, _sums(bare, line_first) / some_words, closed,
        ],
        axis=1,
    )
    return Lines(values, chars, first_line)
