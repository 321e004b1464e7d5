"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, schemes, plus signs, digits and identifier
cues. At each anchor a local parser expands to the boundaries of an item and validates it. Kinds:

* ``email`` around an at-sign; ``ip``, ``card`` from a digit; ``phone`` from a plus sign;
* ``address``: the credentials and host behind a scheme, as in ``ftp://user:pass@host``;
* ``account``: the identifier behind a cue such as ``IBAN`` or ``account no.``, in any letter case; an IBAN
  must pass its check digits, other identifiers need six digits or more.

Items of one kind never overlap; a match that fails validation is dropped and its characters are not tried
again. Positions are code points, ends exclusive. A null or empty text has no items; the list of an id that
is repeated is given for each of its rows. Only ``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
CUES = (
    "iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn",
    "customer id", "member id",
)
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+")
_AUTHORITY = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?")
_AFTER_CUE = re.compile(r"(?: ?(?:no|nr|number|nummer|id)\b\.?)?[ :#=]{1,3}", re.ASCII | re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IDENTIFIER = re.compile(r"[A-Z]{0,3}[0-9](?:[ -]?[0-9]){5,19}\b")

Span = tuple[int, int]


@cache
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor, kind in (("@", "at"), ("://", "scheme"), *((f"+{d}", "plus") for d in _DIGITS)):
        found.add_word(anchor, (kind, len(anchor)))
    for digit in _DIGITS:
        found.add_word(digit, ("digit", 1))
    for cue in CUES:
        found.add_word(cue, ("cue", len(cue)))
    found.make_automaton()
    return found


def ascii_lower(text: str) -> str:
    """Only A-Z lower-cased: the length, and so every position, stays."""
    if text.isascii():
        return text.lower()
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """Check digits: moved to the end, letters as two-digit numbers, the rest modulo 97 is 1."""
    compact = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def email_at(text: str, at: int, floor: int) -> Span | None:
    start = at
    while start > floor and text[start - 1] in LOCAL_PART:
        start -= 1
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if start < at and domain else None


def ips_at(text: str, start: int) -> tuple[list[Span], int]:
    """Valid addresses in a chain of dotted numbers, and the end of the chain."""
    chain = _DOTTED.match(text, start)
    found, place, parts = [], start, chain.group().split(".")
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        end = place + sum(map(len, four)) + 3
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in four):
            found.append((place, end))
        place = end + 1
    return found, chain.end()


def card_at(text: str, start: int) -> tuple[Span | None, int]:
    chain = _GROUPED.match(text, start)
    if not chain:
        return None, start + 1
    digits = chain.group().replace(" ", "").replace("-", "")
    good = 14 <= len(digits) <= 19 and luhn(digits)
    return (chain.span() if good else None), chain.end()


def phone_at(text: str, start: int) -> tuple[Span | None, int]:
    run = _DIALLED.match(text, start)
    dialled = run.group().rstrip(" ().-") if run else ""
    if len(dialled) < 4:
        return None, start + 1
    end = start + len(dialled)
    return ((start, end) if 10 <= sum(c in _DIGITS for c in dialled) <= 15 else None), end


def address_at(text: str, start: int) -> Span | None:
    found = _AUTHORITY.match(text, start)
    return found.span() if found else None


def account_at(text: str, cue_start: int, cue_end: int) -> Span | None:
    if cue_start and text[cue_start - 1].isalnum():
        return None
    gap = _AFTER_CUE.match(text, cue_end)
    if not gap:
        return None
    iban = _IBAN.match(text, gap.end())
    if iban:
        # groups of a following word may have been taken in: give up characters from the end
        for end in range(iban.end(), iban.start() + 14, -1):
            if text[end - 1] != " " and iban_valid(text[iban.start() : end]):
                return iban.start(), end
    number = _IDENTIFIER.match(text, gap.end())
    return number.span() if number else None


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """All items as (start, end, kind), by start, then kind as listed in ``KINDS``."""
    found: list[tuple[int, int, str]] = []
    free = dict.fromkeys(KINDS, 0)  # where the search of each kind goes on

    def keep(kind: str, span: Span | None) -> None:
        if span:
            found.append((*span, kind))

    for last, (anchor, length) in anchors().iter(ascii_lower(text or "")):
        start = last + 1 - length
        if anchor == "digit":
            if start >= free["ip"]:
                spans, free["ip"] = ips_at(text, start)
                for span in spans:
                    keep("ip", span)
            if start >= free["card"]:
                span, free["card"] = card_at(text, start)
                keep("card", span)
        elif anchor == "at":
            if start >= free["email"] and (span := email_at(text, start, free["email"])):
                free["email"] = span[1]
                keep("email", span)
        elif anchor == "plus":
            if start >= free["phone"]:
                span, free["phone"] = phone_at(text, start)
                keep("phone", span)
        elif anchor == "scheme":
            if start >= free["address"] and (span := address_at(text, last + 1)):
                free["address"] = span[1]
                keep("address", span)
        elif start >= free["account"] and (span := account_at(text, start, last + 1)):
            free["account"] = span[1]
            keep("account", span)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def masked(text: str) -> str:
    """The text with each item replaced by its kind; items that overlap become one, named by the first."""
    pieces, place = [], 0
    for start, end, kind in find_spans(text):
        if start >= place:
            pieces += [text[place:start], f"[{kind}]"]
        place = max(place, end)
    return "".join((*pieces, text[place:]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of each document's items; one row per row of ``docs``, without a shuffle."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find_spans(text) for text in batch.column("text").to_pylist()]
            base = [[x for x in one if x[2] in BASE_KINDS] for one in spans]
            counts = [
                pa.array([sum(x[2] == kind for x in one) for one in base], pa.int64())
                for kind in BASE_KINDS
            ]
            digests = [hashlib.sha256(spans_text(one).encode()).hexdigest() for one in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *counts, pa.array(digests, pa.string()),
                    pa.array(map(spans_text, spans), pa.string()),
                ],
                ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{kind} long" for kind in BASE_KINDS)
    return texts.mapInArrow(
        scan, f"doc_id {dict(texts.dtypes)['doc_id']}, {counts}, base_sha256 string, spans string"
    )


def mask(text: Column) -> Column:
    """A text column with its items masked; null stays null."""

    @F.arrow_udf("string")
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None else masked(t) for t in texts.to_pylist()], pa.string())

    return apply(text)
