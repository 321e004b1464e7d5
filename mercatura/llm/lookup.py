"""Which values do other blocks of documents hold? Asked in bulk.

Documents are grouped into blocks of bounded size. A block sends each of its distinct 64-bit values once, cut by
value range into buckets, as one array for each bucket; a bucket, which meets the arrays of all blocks, answers
each block with those of its values that fulfil the question. A value that a third of all documents hold is
thus one number from each block, so no key is hot, and a task holds one bucket or one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text to a block, bytes of text whose values share a bucket, and least number of either.
BLOCK_BYTES, BUCKET_BYTES, LEAST = 8 << 20, 16 << 20, 64
REQUEST = "block int, bucket int, values binary, counts binary"
REPLY = "block int, values binary, counts binary"


def sizes(text_bytes: int) -> tuple[int, int]:
    """Number of blocks, and the number of leading bits of a value that name its bucket."""
    buckets = max(LEAST, -(-text_bytes // BUCKET_BYTES))
    return max(LEAST, -(-text_bytes // BLOCK_BYTES)), (buckets - 1).bit_length()


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def ranges(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """Upper bounds that cut the ids into about n ranges of equal row counts."""
    shares = [k / n for k in range(1, n)]
    found = docs.agg(F.percentile_approx(id_col, shares, max(10_000, 10 * n)).alias("b")).first()[0]
    return sorted(set(found or []))


def range_block(id_col: Column, bounds: list[int]) -> Column:
    """Number of the range that an id falls into; ids that are null come last."""
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(edges, ids.fillna(0).to_numpy(dtype=np.int64), side="left")
        return pd.Series(np.where(ids.isna(), len(edges) + 1, found).astype(np.int32))

    return number(id_col.cast("long"))


def hash_block(id_col: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int")


def requests(block: int, values: np.ndarray, bits: int, counts: np.ndarray | None = None) -> Iterator[dict]:
    """Rows that ask about a block's values, which are sorted and distinct."""
    edges = np.searchsorted(values >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
    for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if a < b:
            yield {
                "block": block,
                "bucket": bucket,
                "values": values[a:b].tobytes(),
                "counts": None if counts is None else counts[a:b].astype(np.uint32).tobytes(),
            }


def request_table(rows: Iterator[dict]) -> pa.Table:
    schema = pa.schema(
        [("block", pa.int32()), ("bucket", pa.int32()), ("values", pa.binary()), ("counts", pa.binary())]
    )
    return pa.Table.from_pylist(list(rows), schema)


def replied(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A block's answers as sorted values, and their counts where counts were sent."""
    values = np.frombuffer(b"".join(table["values"].to_pylist()), dtype=np.uint64)
    counts = np.frombuffer(b"".join(x or b"" for x in table["counts"].to_pylist()), dtype=np.uint32)
    order = np.argsort(values)
    return values[order], counts[order] if len(counts) else counts


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is among ``of``, which is sorted."""
    if not len(of):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(of, values)
    return of[np.minimum(at, len(of) - 1)] == values


def ask(asked: DataFrame, question: str) -> DataFrame:
    """Answers by block: the values that are ``elsewhere`` (in another block), ``earlier`` (in one with a
    smaller number), or whose ``count`` over all blocks is over one, then with that count."""

    def answer(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by("block")
        blocks = bucket["block"].to_numpy()
        arrays = [np.frombuffer(x, dtype=np.uint64) for x in bucket["values"].to_pylist()]
        values = np.concatenate(arrays)
        sent = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
        order = np.argsort(values, kind="stable")  # so a value's blocks stay in order
        ordered = values[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        run = np.cumsum(new) - 1
        totals = None
        if question == "earlier":
            keep = ~new
        elif question == "elsewhere":
            keep = np.bincount(run)[run] > 1
        else:
            counts = np.concatenate(
                [np.frombuffer(x, dtype=np.uint32) for x in bucket["counts"].to_pylist()]
            )
            totals = np.bincount(run, weights=counts[order])[run]
            keep = totals > 1
            totals = np.minimum(totals, 0xFFFFFFFF).astype(np.uint32)[keep]
        kept, to = ordered[keep], sent[order][keep]
        by_block = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[by_block], np.arange(len(arrays) + 1))
        rows = [
            {
                "block": int(blocks[i]),
                "values": kept[by_block[a:b]].tobytes(),
                "counts": None if totals is None else totals[by_block[a:b]].tobytes(),
            }
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if a < b
        ]
        schema = pa.schema([("block", pa.int32()), ("values", pa.binary()), ("counts", pa.binary())])
        return pa.Table.from_pylist(rows, schema)

    return asked.groupBy("bucket").applyInArrow(answer, REPLY)
