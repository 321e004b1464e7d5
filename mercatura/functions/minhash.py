"""MinHash family: h -> (h*a + b) mod p with every product below 2**63, so ANSI mode never overflows."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

# Signature layout and seed of the hash family.
SIGNATURE_SIZE = 128
BANDS = 32
ROWS = 4
SEED = 20240917
PRIME = 2**31 - 1


def _draw(seed: int, name: str, i: int) -> int:
    digest = hashlib.md5(f"{seed}/{name}/{i}".encode()).hexdigest()
    return int(digest[:8], 16) % (PRIME - 1) + 1


def coefficients(count: int, seed: int = SEED) -> list[tuple[int, int]]:
    return [(_draw(seed, "a", i), _draw(seed, "b", i)) for i in range(count)]


def shingle_hash(shingle: Column) -> Column:
    """The first 32 bits of the shingle's MD5."""
    return F.conv(F.substring(F.md5(shingle), 1, 8), 16, 10).cast("bigint")


def bucket_key(values: list[Column]) -> Column:
    return F.substring(F.md5(F.concat_ws(",", *[v.cast("string") for v in values])), 1, 12)
