"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct word n-grams. Two documents link when the sets' intersection has at
least ``share`` of their union; the result is one row a document with the smallest id that links reach.

1. Which n-grams are shared? In the order of their hashes, each document asks about the first
   ``2 * slack + 1`` of its n, where ``slack = n - ceil(share * n)`` is the number it may have alone. The
   first ``slack + k`` of two documents that link have k in common, for any k. So a document that finds no more
   than the slack of its smallest possible partner in other documents' first ones has no partner, and is done.
2. The others are counted against each other, so the n-grams have a global order: rarest first. Of two
   documents that link, the first ``slack + 1`` in that order have one in common, so documents meet under those.
   Equal sets are one from here on.
3. The global order of n-grams by hash is cut into fragments; each set becomes a segment for each fragment. A
   pair's overlaps are counted fragment by fragment and summed, so a long document is spread over many rows.
4. Under a common n-gram, documents are first compared with one pivot, which is linear, and linked ones
   form components. Pivots change for some rounds; only then are the documents that still meet in different
   components compared pairwise, where the n-grams that each has in common with any other allow a link. A
   large group of copies is never paired up.

Links between documents of one component can't change the result, so the answer is that of all pairs. Words are
maximal runs of characters other than blank, tab and line or page breaks, with A-Z lower-cased. A document
with fewer than n words has its whole sequence as its only n-gram; a null, empty or blank text has none and
links with nothing. Ids that are null get a component of null. Rows that share an id are one node: a link of
one is a link of all; each row keeps its own set size. An empty table gives an empty table. Only the two
named columns are read. N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.llm import lookup, words
from mercatura.llm.common import bounded_batches
from mercatura.operators.joins import join_by_key
from mercatura.operators.resolve import connected_components
from mercatura.session import stage

FRAGMENT_BITS = 4
#: Rounds of comparing with pivots before what is left is compared pairwise.
PIVOT_ROUNDS = 3


class Sets:
    """The n-gram sets of a table's texts, each as sorted distinct hashes."""

    def __init__(self, table: pa.Table, n: int):
        data, offsets = words.utf8(table["text"].cast(pa.large_string()).combine_chunks())
        found = words.split(data, offsets)
        hashed = words.hashes(found, fold_case=True)
        grams = words.windows(hashed, n)
        self.each = []
        for a, b in zip(found.first[:-1], found.first[1:], strict=True):
            if b - a >= n:
                self.each.append(np.unique(grams[a : b - n + 1]))
            else:
                self.each.append(words.windows(hashed[a:b], b - a) if a < b else np.zeros(0, np.uint64))


def slack(n: int, share: tuple[int, int]) -> int:
    """How many n-grams of n a document may have that a partner lacks: n - ceil(share * n)."""
    return n - _least(n, share)


def _least(n: int, share: tuple[int, int]) -> int:
    """Size of the smallest partner of a set of n."""
    return -(-n * share[0] // share[1])


def _first_asked(grams: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The smallest n-grams, mixed again: they crowd at one end of the range that buckets are cut from."""
    return words.mix(grams[: 2 * slack(len(grams), share) + 1])


def _locally_shared(arrays: list[np.ndarray]) -> np.ndarray:
    """Sorted values that more than one of the arrays holds; each array holds a value once."""
    values = np.sort(np.concatenate(arrays)) if arrays else np.zeros(0, np.uint64)
    return np.unique(values[1:][values[1:] == values[:-1]])


def _distinct(arrays: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(arrays)) if arrays else np.zeros(0, np.uint64)


def shared_sets(texts: DataFrame, n: int, share: tuple[int, int], n_blocks: int, bits: int) -> DataFrame:
    """Each row's set size, and the set where it may have a partner: block, doc_id, n_shingles, grams."""
    # the text spreads the rows that share an id, or have none
    number = lookup.hash_block(F.concat_ws("|", F.col("doc_id"), F.xxhash64("text")), n_blocks)
    blocks = texts.withColumn("block", number).groupBy("block")

    def ask(table: pa.Table) -> pa.Table:
        asked = [_first_asked(grams, share) for grams in Sets(table, n).each]
        return lookup.request_table(lookup.requests(table["block"][0].as_py(), _distinct(asked), bits))

    def judge(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        sets = Sets(table, n).each
        asked = [_first_asked(grams, share) for grams in sets]
        elsewhere, _ = lookup.replied(answers)
        here = _locally_shared(asked)
        grams = []
        for one, first in zip(sets, asked, strict=True):
            found = lookup.member(first, elsewhere) | lookup.member(first, here)
            grams.append(one.tobytes() if found.sum() > slack(_least(len(one), share), share) else None)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(sets), pa.int32()),
                "doc_id": table["doc_id"],
                "n_shingles": pa.array([len(one) for one in sets], pa.int64()),
                "grams": pa.array(grams, pa.binary()),
            }
        )

    answers = lookup.ask(blocks.applyInArrow(ask, lookup.REQUEST), "elsewhere")
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(
        judge, "block int, doc_id long, n_shingles long, grams binary"
    )


def rare_prefixes(sets: DataFrame, share: tuple[int, int], bits: int) -> DataFrame:
    """N-grams under which a document can meet a partner: gram, doc, size, common. ``sets``: block, doc, grams.

    ``common`` is how many n-grams the document can share with one that it first meets here, in the global
    order: those that other documents have too, and no more than are left from here on. Two documents that
    link pass any test of that number under the first n-gram that they share.
    """
    blocks = sets.groupBy("block")

    def arrays(table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype=np.uint64) for x in table["grams"].to_pylist()]

    def ask(table: pa.Table) -> pa.Table:
        values, counts = np.unique(np.concatenate(arrays(table)), return_counts=True)
        return lookup.request_table(
            lookup.requests(table["block"][0].as_py(), values, bits, counts)
        )

    def order(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        known_grams, counts = lookup.replied(answers)
        rows = [(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))]
        for doc, grams in zip(table["doc"].to_pylist(), arrays(table), strict=True):
            held = np.ones(len(grams), dtype=np.int64)
            known = lookup.member(grams, known_grams)
            held[known] = counts[np.searchsorted(known_grams, grams[known])]
            first = np.lexsort((grams, held))[: slack(len(grams), share) + 1]
            place = np.flatnonzero(held[first] > 1)
            first = first[place]
            same = np.ones(len(first), dtype=np.int64)
            rows.append((grams[first], same * doc, same * len(grams), np.minimum((held > 1).sum(), len(grams) - place)))
        gram, doc, size, common = (np.concatenate(x) for x in zip(*rows, strict=True))
        return pa.table({"gram": gram.view(np.int64), "doc": doc, "size": size, "common": common})

    answers = lookup.ask(blocks.applyInArrow(ask, lookup.REQUEST), "count")
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(
        order, "gram long, doc long, size long, common long"
    )


def segments(sets: DataFrame) -> DataFrame:
    """Sets cut at fixed places of the global order of n-grams: doc, fragment, grams."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - FRAGMENT_BITS)
        for batch in batches:
            docs, fragments, parts = [], [], []
            for doc, raw in zip(batch["doc"].to_pylist(), batch["grams"].to_pylist(), strict=True):
                grams = np.frombuffer(raw, dtype=np.uint64)
                edges = np.searchsorted(grams >> shift, np.arange((1 << FRAGMENT_BITS) + 1))
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    if a < b:
                        docs.append(doc)
                        fragments.append(k)
                        parts.append(grams[a:b].tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": pa.array(docs, pa.int64()),
                    "fragment": pa.array(fragments, pa.int32()),
                    "grams": pa.array(parts, pa.binary()),
                }
            )

    return sets.select("doc", "grams").mapInArrow(cut, "doc long, fragment int, grams binary")


@F.arrow_udf(T.LongType())
def partial_overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    """Size of the intersection of two segments of the same fragment."""
    found = []
    for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
        x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
        found.append(int(lookup.member(x, y).sum()))
    return pa.array(found, pa.int64())


def _compatible(share: tuple[int, int]) -> Column:
    """Whether documents a and b may link if they first meet here: they share no more than either's ``common``."""
    most = F.least("common_a", "common_b")
    return share[1] * most >= share[0] * (F.col("size_a") + F.col("size_b") - most)


def _side(postings: DataFrame, side: str) -> DataFrame:
    columns = ("size", "common", "component")
    return postings.select("gram", F.col("doc").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))


def _pairs(met: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs of different components that may link; a pair may meet under many n-grams."""
    apart = met.filter((F.col("component_a") != F.col("component_b")) & _compatible(share))
    return stage(apart.select("a", "size_a", "b", "size_b").distinct(), "pairs")


def linked(pairs: DataFrame, cut: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, size_a, b, size_b) that link, by the sum of their partial overlaps: a, b."""
    left = cut.select(F.col("doc").alias("a"), "fragment", F.col("grams").alias("left"))
    right = cut.select(F.col("doc").alias("b"), "fragment", F.col("grams").alias("right"))
    parts = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "size_a", "size_b", partial_overlap("left", "right").alias("overlap"))
    )
    summed = parts.groupBy("a", "b", "size_a", "size_b").agg(F.sum("overlap").alias("overlap"))
    union = F.col("size_a") + F.col("size_b") - F.col("overlap")
    return summed.filter(share[1] * F.col("overlap") >= share[0] * union).select("a", "b")


def _with_pivots(postings: DataFrame, turn: int) -> DataFrame:
    """Documents with the pivot of each of their n-grams.

    First the one with the fewest n-grams that it can't share, which most others link with; then the same of
    a component that changes from turn to turn.
    """
    own = F.col("size") - F.col("common")
    drawn = F.xxhash64(F.lit(turn), "component") if turn else F.lit(0).cast("long")
    rank = F.struct(drawn.alias("drawn"), own.alias("own"), "doc", "size", "common", "component")
    best = postings.groupBy("gram").agg(F.min(rank).alias("pivot")).select("gram", "pivot.*")
    pivots = stage(_side(best, "a"), "pivots")
    return _side(postings, "b").join(pivots, "gram")


def _open(postings: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Postings under which a document may still find a link to another component.

    Even the smallest document under an n-gram must be small enough for what the posting's document can
    share from there on.
    """
    smallest = F.min("size").alias("smallest")
    per_gram = postings.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), smallest
    )
    found = postings.join(stage(per_gram.filter("low < high"), "mixed"), "gram")
    reach = share[1] * F.col("common") >= share[0] * (F.col("size") + F.col("smallest") - F.col("common"))
    return found.filter(reach).select(*postings.columns)


def _mixed(postings: DataFrame, share: tuple[int, int]) -> DataFrame:
    """As ``_open``, twice: without the postings that go first, some n-grams hold one component only."""
    return stage(_open(stage(_open(postings, share), "open"), share), "open")


def _relabelled(postings: DataFrame, components: DataFrame) -> DataFrame:
    return postings.drop("component").join(
        components.withColumnRenamed("node", "doc"), "doc", "left"
    ).withColumn("component", F.coalesce("component", "doc"))


def components_of(
    postings: DataFrame, cut: DataFrame, known: DataFrame, share: tuple[int, int]
) -> DataFrame:
    """Components of the links between documents, and of links that are ``known`` (a, b): node, component.

    ``postings``: gram, doc, size, common. Only links that connect what is still apart are looked for.
    """
    left = _mixed(postings.withColumn("component", F.col("doc")), share)
    links, found, turn = known, None, 0
    while turn <= PIVOT_ROUNDS and not left.isEmpty():
        if turn < PIVOT_ROUNDS:
            met = _with_pivots(left, turn)
        else:
            met = _side(left, "a").join(_side(left, "b"), "gram").filter("a < b")
        new = stage(linked(_pairs(met, share), cut, share), "links")
        if new.isEmpty():  # then another pivot isn't worth a round: what is left is compared at once
            turn = PIVOT_ROUNDS if turn < PIVOT_ROUNDS else turn + 1
            continue
        links = links.unionByName(new)
        found = stage(connected_components(links), "components")
        turn += 1
        if turn <= PIVOT_ROUNDS:
            left = _mixed(_relabelled(left, found), share)
    return stage(connected_components(links), "components") if found is None else found


def jaccard_components(
    docs: DataFrame,
    n: int = 4,
    share: tuple[int, int] = (85, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Set size and component of every row: doc_id, n_shingles, component_id."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_blocks, bits = lookup.sizes(lookup.text_bytes(texts))
    every = shared_sets(texts, n, share, n_blocks, bits).withColumn(
        "node", F.when(F.col("doc_id").isNotNull() & F.col("grams").isNotNull(), F.xxhash64(F.sha2("grams", 256)))
    )
    every = stage(every, "sets")
    rows = every.filter("node IS NOT NULL")
    sets = stage(rows.select("node", "block", "grams").dropDuplicates(["node"]), "distinct")
    sets = sets.withColumnRenamed("node", "doc")
    # rows that share an id are one: their sets are linked
    by_id = rows.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high")).filter("a < high")
    known = rows.join(stage(by_id.select("doc_id", "a"), "repeated"), "doc_id").select("a", F.col("node").alias("b"))
    postings = stage(rare_prefixes(sets, share, bits), "postings")
    found = components_of(postings, segments(sets), known, share)
    lowest = rows.groupBy("node").agg(F.min("doc_id").alias("id"))
    owned = stage(
        lowest.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "owned"
    )
    ids = stage(owned.groupBy("component").agg(F.min("id").alias("component_id")), "lowest")
    named = stage(owned.join(ids, "component").select("node", "component_id"), "named")
    placed = stage(rows.join(named, "node").select("doc_id", "n_shingles", "component_id"), "placed")
    # a row without partners is still of its id's component, if another row of that id has one
    of_id = placed.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    lone = join_by_key(every.filter("node IS NULL").select("doc_id", "n_shingles"), of_id, ["doc_id"], "left")
    return placed.unionByName(lone.withColumn("component_id", F.coalesce("component_id", "doc_id")))
