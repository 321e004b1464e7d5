"""Token ids of whole texts, equal to those of the tokenizers library, with repeated words encoded once.

For a tokenizer whose pieces never span white space, a text's ids are the ids of its words one after the other.
Texts of plain Latin letters, digits and ASCII signs skip the normalizer: their pieces are marked here and merged by
``Merges``. Of other texts a worker keeps the ids of words it has met, in a table of bounded size; new words that
are plain go the same way, all others, and texts with unusual white space, through the whole tokenizer. So the ids
are the library's in every case.

The tokenizer is handed over as the text of its JSON file, which is broadcast.
"""

from __future__ import annotations

import json
import re
from functools import cache
from itertools import chain

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Entries of a worker's tables of words and of their pieces.
WORDS, PIECES = 250_000, 200_000
#: Longer words go through the whole tokenizer, whose merges take less than quadratic time.
LONGEST = 400
# White space that either side treats differently from blanks and line breaks.
_ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-`{-~]+")
_PLAIN_TEXT = re.compile(r"[ \t\n\r!-~À-ÖØ-öø-ÿ]+")
#: The pre-tokenizer and normalizer that the short way reproduces; fixed values.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_END = "</w>"
# Byte behind a piece, which plain texts don't hold.
_MARK = b"\x01"


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


@cache
def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if visible, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class Table(dict):
    """Newer entries of a table of bounded size; when they are half of it, the older half is given up.

    Entries that are asked for again move to the newer half, so frequent words stay.
    """

    def __init__(self, size: int):
        super().__init__()
        self.half, self.older = size // 2, {}

    def lacking(self, keys: set[str]) -> set[str]:
        """Which keys are in neither half; all others are in the newer half afterwards."""
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()
        lacking = keys.difference(self)
        known = lacking.intersection(self.older)
        self.update(zip(known, map(self.older.__getitem__, known), strict=True))
        return lacking.difference(known)


class Merges:
    """Byte-pair merges of plain pieces, by tiktoken.

    The end of a piece is written as a byte of its own behind it, and joining that byte with the one before comes
    before all other merges. Merging by the rank of the merged token instead of the listed pair is the same for a
    vocabulary in which every token's own text is merged to that token, as tests check.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list):
        self.byte_of = {letter: b for b, letter in _byte_letters().items()}
        ranks = {bytes([k]): k for k in range(256)}
        ranks |= {bytes([k]) + _MARK: 256 + k for k in range(256)}
        self.ids = np.zeros(512 + len(merges), "<u4")
        for token, number in vocabulary.items():
            code = self.code(token)
            if code in ranks:
                self.ids[ranks[code]] = number
        for k, pair in enumerate(merges):
            token = "".join(pair.split(" ") if isinstance(pair, str) else pair)
            code = self.code(token)
            if code is not None:
                ranks[code] = 512 + k
                self.ids[512 + k] = vocabulary[token]
        # what is not a marked piece is passed over
        self.merge = tiktoken.Encoding("merges", pat_str=r"[^\x01\s]+\x01", mergeable_ranks=ranks, special_tokens={})

    def code(self, token: str) -> bytes | None:
        """A token of the vocabulary as bytes; none if it holds a byte that is not one of plain pieces."""
        ends = token.endswith(_END)
        raw = [self.byte_of.get(c) for c in (token[: -len(_END)] if ends else token)]
        return None if None in raw or _MARK[0] in raw else bytes(raw) + _MARK * ends

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of single pieces."""
        merge = self.merge._core_bpe.encode_single_piece
        found = [merge(piece.encode() + _MARK) for piece in pieces]
        ends = np.cumsum([4 * len(x) for x in found]).tolist()
        ids = self.ids[np.fromiter(chain.from_iterable(found), np.int64)].tobytes()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_marked(self, text: str) -> bytes:
        """Ids of a text whose pieces are marked; white space is passed over."""
        return self.ids.take(np.array(self.merge.encode_ordinary(text), np.int64)).tobytes()


def _kinds() -> np.ndarray:
    """0 for white space, 1 for bytes of letters, 2 for signs, 3 for digits: neighbours of one kind are one piece."""
    kinds = np.full(256, 2, np.uint8)
    kinds[[9, 10, 13, 32]] = 0
    kinds[ord("a") : ord("z") + 1] = 1
    kinds[0x80:] = 1
    kinds[ord("0") : ord("9") + 1] = 3
    return kinds


_KINDS = _kinds()
#: Bytes that are marked at a time.
CHUNK = 1 << 21


def marked(texts: list[str]) -> list[str]:
    """Plain texts in lower case, without apostrophes, with a mark behind each piece."""
    found, start = [], 0
    raw = [t.encode() for t in texts]
    while start < len(raw):
        size, stop = len(raw[start]), start + 1
        while stop < len(raw) and size + len(raw[stop]) < CHUNK:
            size, stop = size + len(raw[stop]) + 1, stop + 1
        data = np.frombuffer(b"\n".join(raw[start:stop]) + b"\n", np.uint8)
        kinds = _KINDS[data]
        ends = (kinds != 0) & (kinds == 3)
        ends[:-1] |= (kinds[:-1] != 0) & (kinds[:-1] != kinds[1:])
        places = np.flatnonzero(ends)
        written = np.repeat(data, 1 + ends.view(np.uint8))
        written[places + np.arange(1, len(places) + 1)] = _MARK[0]
        edges = np.cumsum([0, *(len(x) + 1 for x in raw[start:stop])])
        edges += np.searchsorted(places, edges)
        found += [bytes(written[a : b - 1]).decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        start = stop
    return found


class Encoder:
    def __init__(self, definition: str):
        self.whole = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        split = [x for x in (parts["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split"]
        self.short_way = (
            parts["model"].get("end_of_word_suffix") == _END
            and [x["pattern"].get("Regex") for x in split] == [_SPLIT]
            and [x["type"] for x in parts["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        )
        if not self.short_way:
            return
        self.special = [x["content"] for x in parts["added_tokens"]]
        self.merges = Merges(self.whole.get_vocab(), parts["model"]["merges"])
        self.words, self.pieces = Table(WORDS), Table(PIECES)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; of a null text none."""
        texts = ["" if t is None else t for t in texts]
        if not self.short_way:
            return self._by_library(texts)
        found: list[bytes | None] = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self._is_plain(t)]
        simple = [k for k in plain if "'" not in texts[k]]
        ready = dict(zip(simple, marked([texts[k].lower() for k in simple]), strict=True))
        for k in plain:
            text = ready.pop(k, None)
            found[k] = self.merges.encode_marked(_PIECE.sub("\\g<0>\x01", texts[k].lower()) if text is None else text)
        for k, text in enumerate(texts):
            if found[k] is None and _ODD_SPACE.search(text):
                found[k] = self._by_library([text])[0]
        rest = [k for k, ids in enumerate(found) if ids is None]
        cut = [texts[k].split() for k in rest]
        self._learn(self.words.lacking(set().union(*cut)))
        for k, words in zip(rest, cut, strict=True):
            found[k] = b"".join([self.words[w] for w in words])
        return found

    def _is_plain(self, text: str) -> bool:
        """Whether the short way takes the text as a whole."""
        plain = _PLAIN_TEXT.fullmatch(text) and not any(s in text for s in self.special)
        return bool(plain) and (len(text) <= LONGEST or max(map(len, text.split()), default=0) <= LONGEST)

    def _by_library(self, texts: list[str]) -> list[bytes]:
        encoded = (self.whole.encode(t, add_special_tokens=False).ids for t in texts)
        return [np.array(ids, dtype="<u4").tobytes() for ids in encoded]

    def _learn(self, words: set[str]) -> None:
        plain = [w for w in words if len(w) <= LONGEST and _PLAIN.fullmatch(w) and not any(s in w for s in self.special)]
        rest = list(words.difference(plain))
        for word, ids in zip(rest, self._by_library(rest), strict=True):
            self.words[word] = ids
        cut = [_PIECE.findall(w.lower()) for w in plain]
        new = list(self.pieces.lacking({p for pieces in cut for p in pieces}))
        if new:
            self.pieces.update(zip(new, self.merges.encode(new), strict=True))
        known = self.pieces
        for word, pieces in zip(plain, cut, strict=True):
            self.words[word] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])


@cache
def encoder(definition: str) -> Encoder:
    """One encoder for each worker, which keeps its tables from task to task."""
    return Encoder(definition)
