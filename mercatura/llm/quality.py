"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is labelled good or bad. A line's features are its measures and those of the lines before and
behind it, each cut into bins; the chain adds weights for the first line and for each pair of neighbouring
labels. The forward-backward algorithm gives each line's probability of being good; their mean, weighted by
the lines' lengths, is the document's. A logistic curve, fitted on the same sample, turns it into the score.

Labels are given for documents, not lines. At first all lines of a bad document count as bad; after a first
fit, lines of bad documents that the field takes for good are relabelled, and the field is fitted anew.

The field is fitted on a bounded sample of labelled documents: of each label the ``per_label`` ones with the
smallest hash of their id, without those of more than ``MAX_LINES`` lines. Only labels of rows that the caller
passes are used. All else covers all documents and whole texts.

A null or empty text is one empty line and gets a score like others. Null labels and ids are not fitted on.
Rows that share an id are scored one by one. An empty table gives an empty table; without labels of both
kinds all scores are one half. Only the named columns are read, so labels, language and source are never
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm import lines, words
from mercatura.llm.common import bounded_batches

PER_LABEL, MAX_LINES = 1500, 256
#: Bins of a measure, relabelling rounds, steps of a fit and weight of the penalty on large weights.
BINS, RELABELLINGS, STEPS, PENALTY = 8, 2, 100, 1e-3


class Chains:
    """The order in which the recursions meet the lines of many texts: all first lines, all second ones, ...

    Texts come by falling numbers of lines, so the texts that have a next line are always the first ones.
    """

    def __init__(self, first: np.ndarray):
        self.first, self.sizes = first, np.diff(first)
        self.text = words.owners(first)
        place = np.arange(len(self.text)) - first[:-1][self.text]
        rank = np.empty(len(self.sizes), dtype=np.int64)
        rank[np.argsort(-self.sizes, kind="stable")] = np.arange(len(self.sizes))
        self.order = np.lexsort((rank[self.text], place))
        self.upto = np.concatenate(([0], np.cumsum(np.bincount(place))))

    def steps(self) -> list[tuple[int, int, int]]:
        """Start of the step before, start and end of each step but the first."""
        return [(int(self.upto[t - 1]), int(self.upto[t]), int(self.upto[t + 1])) for t in range(1, len(self.upto) - 1)]


@dataclass
class Field:
    """Weights: ``emission`` of being bad for each feature, ``start`` of a bad first line, ``step`` by labels."""

    edges: np.ndarray
    emission: np.ndarray
    start: float = 0.0
    step: np.ndarray = None
    slope: float = 1.0
    shift: float = 0.0

    def features(self, found: lines.Lines) -> np.ndarray:
        """Feature numbers of each line: a bin of each of its measures, and of its neighbours'."""
        n, k = found.values.shape
        bins = np.stack([np.searchsorted(self.edges[j], found.values[:, j], side="right") for j in range(k)], axis=1)
        bins += np.arange(k) * (BINS + 1)
        none = np.arange(k) * (BINS + 1) + BINS  # a bin for a neighbour that isn't there
        before, behind = np.vstack((none, bins[:-1])), np.vstack((bins[1:], none))
        before[found.first[:-1]] = none
        behind[found.first[1:] - 1] = none
        size = k * (BINS + 1)
        return np.hstack((bins, before + size, behind + 2 * size))

    def marginals(self, features: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
        """Each line's probability of being bad, and the expected number of each pair of labels.

        With two labels, forward and backward messages are one number a line: the log odds of bad.
        """
        score = self.emission[features].sum(axis=1)[chains.order]
        step = self.step
        ahead = score.copy()
        ahead[: chains.upto[1]] += self.start
        for before, at, end in chains.steps():
            x = ahead[before : before + end - at]
            ahead[at:end] += np.logaddexp(step[0, 1], x + step[1, 1]) - np.logaddexp(step[0, 0], x + step[1, 0])
        behind = np.zeros(len(score))
        for before, at, end in reversed(chains.steps()):
            x = behind[at:end] + score[at:end]
            behind[before : before + end - at] = np.logaddexp(step[1, 0], x + step[1, 1]) - np.logaddexp(
                step[0, 0], x + step[0, 1]
            )
        bad = np.empty(len(score))
        bad[chains.order] = _sigmoid(ahead + behind)
        sources = [np.arange(before, before + end - at) for before, at, end in chains.steps()]
        x = ahead[np.concatenate(sources)] if sources else np.zeros(0)
        y = (score + behind)[chains.upto[1] :]
        joint = np.stack([a * x + b * y + step[a, b] for a in (0, 1) for b in (0, 1)])
        joint = np.exp(joint - joint.max(axis=0, initial=-np.inf))
        return bad, (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)

    def quality(self, found: lines.Lines) -> np.ndarray:
        """Length-weighted mean probability of good lines by text."""
        chains = Chains(found.first)
        good = 1 - self.marginals(self.features(found), chains)[0]
        weight = found.chars + 1
        whole = lambda x: np.bincount(chains.text, x, len(chains.sizes))
        return whole(good * weight) / whole(weight)

    def score(self, found: lines.Lines) -> np.ndarray:
        return _sigmoid(self.slope * _logit(self.quality(found)) + self.shift)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _fit_labels(field: Field, features: np.ndarray, chains: Chains, bad: np.ndarray, weight: np.ndarray) -> None:
    """Raise the likelihood of line labels (1 is bad) by gradient steps of adaptive size."""
    n = len(chains.sizes)
    firsts = chains.first[:-1]
    same = chains.text[1:] == chains.text[:-1]
    wanted = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            wanted[a, b] = ((bad[:-1] == a) & (bad[1:] == b) & same).sum()
    vector = np.concatenate((field.emission, [field.start], field.step.ravel()))
    mean, square = np.zeros_like(vector), np.zeros_like(vector)
    for step in range(1, STEPS + 1):
        got, pairs = field.marginals(features, chains)
        gap = (bad - got) * weight
        by_feature = np.bincount(
            features.ravel(), np.repeat(gap, features.shape[1]), len(field.emission)
        )
        gradient = np.concatenate((by_feature, [gap[firsts].sum()], (wanted - pairs).ravel())) / n
        gradient -= PENALTY * vector
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        vector = vector + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        field.emission, field.start = vector[:-5], float(vector[-5])
        field.step = vector[-4:].reshape(2, 2)


def _fit_curve(x: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small penalty."""
    design = np.stack((x, np.ones_like(x)), axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(design @ w)
        gradient = design.T @ (weight * (good - p)) - 1e-3 * w
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(curvature, gradient)
        w = w + np.clip(move, -2, 2)
    return float(w[0]), float(w[1])


def fit_field(found: lines.Lines, bad_text: np.ndarray, shares: tuple[float, float]) -> Field:
    """Fit on texts whose labels are ``bad_text``; ``shares`` are the labels' shares among all labelled rows."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(found.values, quantiles, axis=0).T
    size = 3 * found.values.shape[1] * (BINS + 1)
    field = Field(edges, np.zeros(size), 0.0, np.zeros((2, 2)))
    chains, features = Chains(found.first), field.features(found)
    # the lines of a long text count less, so it doesn't outweigh others
    weight = 1 / np.sqrt(chains.sizes[chains.text])
    bad = bad_text[chains.text].astype(float)
    for turn in range(RELABELLINGS + 1):
        if turn:
            got = field.marginals(features, chains)[0]
            worst = np.zeros(len(chains.sizes))
            np.maximum.at(worst, chains.text, got)
            bad = (bad_text[chains.text] & ((got >= 0.5) | (got >= worst[chains.text]))).astype(float)
        _fit_labels(field, features, chains, bad, weight)
    share = np.where(bad_text, shares[1], shares[0]) / np.where(bad_text, bad_text.mean(), 1 - bad_text.mean())
    field.slope, field.shift = _fit_curve(_logit(field.quality(found)), 1.0 - bad_text, share)
    return field


def sample(
    docs: DataFrame, labels: DataFrame, per_label: int, id_col: str, text_col: str, label_col: str
) -> tuple[lines.Lines, np.ndarray]:
    """Measures of the lines to fit on, and which texts are bad; at most ``per_label`` texts of each label.

    Texts are measured where they are read; the driver gets some hundred bytes a line.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("good")).filter(
        F.col("doc_id").isNotNull() & F.col("good").isin(0, 1)
    )
    picked = None
    for good in (0, 1):
        some = known.filter(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = F.length("text") - F.length(F.replace("text", F.lit("\n"))) < MAX_LINES
    # at most twice per_label rows are broadcast
    chosen = texts.join(F.broadcast(picked.distinct()), "doc_id").filter(short).select("text", "good")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = lines.measure(*words.utf8(batch.column("text")))
            edges = list(zip(found.first[:-1], found.first[1:], strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    "good": batch.column("good"),
                    "values": pa.array([found.values[a:b].tobytes() for a, b in edges], pa.binary()),
                    "chars": pa.array([found.chars[a:b].tobytes() for a, b in edges], pa.binary()),
                }
            )

    table = chosen.mapInArrow(measured, "good int, values binary, chars binary").toArrow()
    values, chars = (np.frombuffer(b"".join(table[c].to_pylist())) for c in ("values", "chars"))
    sizes = [len(x) // 8 for x in table["chars"].to_pylist()]
    first = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return lines.Lines(values.reshape(-1, len(lines.NAMES)), chars, first), table["good"].to_numpy() == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = PER_LABEL,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Field | None:
    """A field fitted on a bounded sample of the labelled rows; None without labels of both kinds."""
    bounded_batches(docs.sparkSession)
    counts = dict(labels.groupBy(F.col(label_col).cast("int")).count().collect())
    total = counts.get(0, 0) + counts.get(1, 0)
    found, bad = sample(docs, labels, per_label, id_col, text_col, label_col)
    if not bad.any() or bad.all():
        return None
    return fit_field(found, bad, (counts[1] / total, counts[0] / total))


def score(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (1 is good) of every row, without a shuffle."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), score_column(docs, F.col(text_col), field).alias("score"))
    return texts


def score_column(docs: DataFrame, text: Column, field: Field | None) -> Column:
    """The score as a column, for tables whose other columns are to be kept."""
    if field is None:
        return F.lit(0.5)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("double")
    def apply(texts: pa.Array) -> pa.Array:
        data, offsets = words.utf8(texts)
        return pa.array(shared.value.score(lines.measure(data, offsets)), pa.float64())

    return apply(text)
