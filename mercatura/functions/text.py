"""Text cleaning, shingling and Jaccard as column expressions.

Patterns run on text folded to ASCII. A non-ASCII letter or digit becomes ``_`` (a word character, so
word boundaries stay where Unicode-aware matching would put them) and any other non-ASCII character
becomes a space; the last normalising step turns both into separators.

Shingles come from look-ahead regular expressions, which walk the text once. Indexing words or
characters inside a lambda instead is re-evaluated per element and goes quadratic on long texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Noise patterns, in the order in which they are removed. They begin with a look at the next character,
# which costs far less than a word boundary at every place of a text.
REFERENCE_NUMBER = r"(?i)(?=[nspmrt])\b(?:npas|spc|pwd|mc|ref|tn)[-/A-Za-z0-9]+\b"
NUMERIC_DATE = r"(?=\d)\b\d{1,4}[-/\.]\d{1,2}[-/\.]\d{1,4}\b"
MONTH_NAME_DATE = (
    r"(?i)(?=\d)\b\d{1,2}\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{2,4}\b"
)
CURRENCY = r"(?i)(?=[ri])\b(?:rs\.?|inr|rupees)\s*[\d,]+(?:\.\d+)?(?:\s*(?:lakh|cr|crore|only))?\b"
NOISE_PATTERNS = (REFERENCE_NUMBER, NUMERIC_DATE, MONTH_NAME_DATE, CURRENCY)
NOISE_PATTERNS_WITHOUT_MONTH_NAMES = (REFERENCE_NUMBER, NUMERIC_DATE, CURRENCY)
# Phrases the older normaliser deletes.
AGGREGATOR_PHRASES = ("NATIONAL PROCUREMENT AGGREGATION SERVICE", "STATE PROCUREMENT CELL")

# Every character Python or Unicode calls white space.
BLANKS = r"[\t-\r\x1C-\x20\x{85}\p{Z}]+"


@dataclass(frozen=True)
class BoilerplateRule:
    """For these sources keep the text from ``start`` on, and drop it from ``end`` on."""

    sources: tuple[str, ...]
    start: str | None = None
    end: str | None = None


# The two families of aggregating sources and their markers.
BOILERPLATE_RULES = (
    BoilerplateRule(("P001", "P002", "P005"), "NOTICE DETAILS FOLLOW", "Disclaimer:"),
    BoilerplateRule(("P003", "P004", "P006"), "=" * 79),
)


def _from_marker(text: Column, marker: str) -> Column:
    at = F.locate(marker, text)
    return F.when(at > 0, text.substr(at, F.length(text))).otherwise(text)


def _to_marker(text: Column, marker: str) -> Column:
    at = F.locate(marker, text)
    return F.when(at > 0, text.substr(F.lit(1), at - 1)).otherwise(text)


def strip_boilerplate(text: Column, source: Column, rules=BOILERPLATE_RULES) -> Column:
    text = F.coalesce(text, F.lit(""))
    stripped = text
    for rule in rules:
        cut = text
        if rule.start:
            cut = _from_marker(cut, rule.start)
        if rule.end:
            cut = _to_marker(cut, rule.end)
        stripped = F.when(source.isin(*rule.sources), cut).otherwise(stripped)
    return stripped


def fold_ascii(text: Column) -> Column:
    """A text whose characters are all bytes is ASCII already."""
    blanked = F.regexp_replace(text, r"[^\x00-\x7F\p{L}\p{N}]", " ")
    folded = F.regexp_replace(blanked, r"[^\x00-\x7F]", "_")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)


def strip_noise(text: Column, patterns=NOISE_PATTERNS) -> Column:
    text = fold_ascii(text)
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, " ")
    return text


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def clean_text(
    text: Column, source: Column, rules=BOILERPLATE_RULES, patterns=NOISE_PATTERNS
) -> Column:
    return squeeze(strip_noise(strip_boilerplate(text, source, rules), patterns))


def clean_text_simple(text: Column, phrases=AGGREGATOR_PHRASES) -> Column:
    out = F.upper(F.coalesce(text, F.lit("")))
    for phrase in phrases:
        out = F.replace(out, F.lit(phrase), F.lit(""))
    out = F.regexp_replace(out, r"\p{Nd}+", "")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}_\t-\r\x1C-\x20\x{85}\p{Z}]", "")
    return F.trim(F.regexp_replace(out, BLANKS, " "))


def _all(text: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def word_bigrams(clean: Column) -> Column:
    """Distinct adjacent word pairs of cleaned text; a single word stands for itself."""
    none = F.array().cast("array<string>")
    return (
        F.when(clean == "", none)
        .when(F.instr(clean, " ") == 0, F.array(clean))
        .otherwise(_all(clean, r"\b(?=([a-z0-9]+ [a-z0-9]+))[a-z0-9]+"))
    )


def char_kgrams(text: Column, k: int, keep_short: bool) -> Column:
    """Distinct runs of ``k`` characters; shorter text is kept whole, or yields nothing."""
    none = F.array().cast("array<string>")
    short = F.when(text == "", none).otherwise(F.array(text)) if keep_short else none
    return F.when(F.length(text) < k, short).otherwise(_all(text, rf"(?s)(?=(.{{{k}}})).") )


def flat_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BLANKS, " "))


def raw_char_kgrams(text: Column, k: int = 5) -> Column:
    """Character runs of lower-cased raw text with blanks squeezed."""
    return char_kgrams(flat_text(text), k, keep_short=True)


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two sets held as distinct arrays; 0 when either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        shared / (F.size(a) + F.size(b) - shared)
    )


def set_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two set *expressions*, each evaluated once.

    The sets are bound to a lambda variable. Written straight into the score they would be evaluated
    for every mention, and again where a filter on the score is pushed below the projection.
    """
    bound = F.array(F.struct(a.alias("a"), b.alias("b")))
    return F.transform(bound, lambda s: jaccard(s["a"], s["b"]))[0]
