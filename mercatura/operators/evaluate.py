"""Quality of features, estimator, retrieval and threshold against labelled pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercatura.operators import lsh
from mercatura.operators.resolve import cluster_sizes

# Thresholds compared, prices of a false merge and of a missed one, signature sizes
# and band layouts (bands, rows) compared.
THRESHOLDS = (0.40, 0.50, 0.55)
COST_FALSE_MERGE = 50_000
COST_FALSE_SPLIT = 100
ESTIMATOR_SIZES = (32, 64, 128, 256)
CURVES = ((16, 8), (32, 4), (64, 2))

SAME = "label = 'same'"


def separation(scored: DataFrame, features: dict[str, str]) -> DataFrame:
    """Scores by feature and label; ``inverted`` marks a feature that ranks different above same."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(column).alias("score"))
            for name, column in features.items()
        ]
    )
    summary = (
        scored.select("label", F.inline(cells))
        .groupBy("feature", "label")
        .agg(
            F.count("*").alias("n_pairs"),
            F.avg("score").alias("mean"),
            F.min("score").alias("least"),
            F.max("score").alias("most"),
        )
    )
    feature = Window.partitionBy("feature")

    def mean_of(label: str) -> Column:
        return F.max(F.when(F.col("label") == label, F.col("mean"))).over(feature)

    return summary.select(
        "feature",
        "label",
        "n_pairs",
        F.round("mean", 6).alias("mean_score"),
        F.round("least", 6).alias("min_score"),
        F.round("most", 6).alias("max_score"),
        (mean_of("different") > mean_of("same")).alias("inverted"),
    )


def threshold_sweep(
    scored: DataFrame, score: str = "jaccard", thresholds: tuple[float, ...] = THRESHOLDS
) -> DataFrame:
    """Outcome and cost of merging at each threshold, and the cheapest one."""
    taus = F.array(*[F.lit(t) for t in thresholds])
    same, merged = F.expr(SAME), F.col(score) >= F.col("tau")
    counts = (
        scored.select("label", score, F.explode(taus).alias("tau"))
        .groupBy("tau")
        .agg(
            F.count_if(same & merged).alias("tp"),
            F.count_if(~same & merged).alias("fp"),
            F.count_if(same & ~merged).alias("fn"),
        )
    )
    cost = F.col("fp") * COST_FALSE_MERGE + F.col("fn") * COST_FALSE_SPLIT
    required = COST_FALSE_MERGE / (COST_FALSE_MERGE + COST_FALSE_SPLIT)
    precision = F.try_divide("tp", F.col("tp") + F.col("fp"))
    priced = counts.select(
        "*",
        F.round(precision, 6).alias("precision"),
        F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6).alias("recall"),
        cost.alias("cost"),
        F.coalesce(precision >= required, F.lit(False)).alias("worth_merging"),
    )
    one_group = Window.partitionBy(F.lit(0))  # one row per threshold
    best = F.min(F.struct("cost", "tau")).over(one_group)
    return priced.withColumn("cheapest", F.col("tau") == best.getField("tau"))


def equal_positions(layout: lsh.Layout) -> Column:
    """Positions on which the signature parts ``a`` and ``b`` agree."""
    return F.expr(" + ".join(f"if(a.m{i} = b.m{i}, 1, 0)" for i in range(layout.width)))


def estimator_error(
    scored: DataFrame, parts: DataFrame, layout: lsh.Layout, sizes: tuple[int, ...] = ESTIMATOR_SIZES
) -> DataFrame:
    """Error of the MinHash estimate by signature size, and the standard error promised for it.

    ``scored`` holds ``doc_a, doc_b, jaccard``; shorter signatures are prefixes of the longest.
    """
    joined = (
        scored.alias("p")
        .join(parts.alias("a"), F.col("p.doc_a") == F.col("a.doc"))
        .join(
            parts.alias("b"),
            (F.col("p.doc_b") == F.col("b.doc")) & (F.col("a.part") == F.col("b.part")),
        )
        .select(
            "p.doc_a", "p.doc_b", "p.jaccard", F.col("a.part").alias("part"),
            equal_positions(layout).alias("equal"),
        )
    )
    within = [
        F.struct(
            F.lit(k).alias("k"),
            (F.sum(F.when(F.col("part") < k // layout.width, F.col("equal"))) / k).alias("estimate"),
        )
        for k in sizes
    ]
    estimates = (
        joined.groupBy("doc_a", "doc_b", "jaccard")
        .agg(F.array(*within).alias("cells"))
        .select("jaccard", F.inline("cells"))
    )
    error = F.abs(F.col("jaccard") - F.col("estimate"))
    return (
        estimates.groupBy("k")
        .agg(
            F.count("*").alias("n_pairs"),
            F.round(F.avg(error), 6).alias("mean_abs_error"),
            F.round(F.sqrt(F.avg(error * error)), 6).alias("root_mean_sq_error"),
            F.round(F.max(error), 6).alias("max_error"),
        )
        .select(
            "*",
            F.round(1 / (2 * F.sqrt("k")), 6).alias("standard_error_bound"),
            (F.col("k") * 4).alias("signature_bytes"),
        )
    )


def candidate_probability(similarity: Column, bands: int, rows: int) -> Column:
    """Chance that a pair of this similarity shares at least one of the bands."""
    return 1 - F.pow(1 - F.pow(similarity, F.lit(rows)), F.lit(bands))


def curve_threshold(bands: int, rows: int) -> float:
    """Similarity at which the S-curve is steepest, about."""
    return (1 / bands) ** (1 / rows)


def curve_report(scored: DataFrame, shared: str) -> DataFrame:
    """By tenth of similarity: the pairs retrieved, next to what each layout promises."""
    tenth = F.floor(F.col("jaccard") * 10 + 1e-9) / F.lit(10.0)
    grouped = scored.groupBy(tenth.alias("similarity")).agg(
        F.count("*").alias("n_pairs"), F.count_if(F.col(shared) > 0).alias("n_retrieved")
    )
    return grouped.select(
        "*",
        *[
            F.round(candidate_probability(F.col("similarity"), b, r), 4).alias(f"p_{b}x{r}")
            for b, r in CURVES
        ],
    )


def retrieval_recall(pairs: DataFrame, shared: str, kept: str) -> DataFrame:
    """Share of the pairs labelled same that retrieval reaches, before and after a mitigation."""
    same = pairs.filter(F.expr(SAME))
    return same.agg(
        F.count("*").alias("same_pairs"),
        F.count_if(F.col(shared) > 0).alias("retrieved_before"),
        F.count_if(F.col(kept) > 0).alias("retrieved_after"),
    ).select(
        "*",
        F.round(F.try_divide("retrieved_before", "same_pairs"), 6).alias("recall_before"),
        F.round(F.try_divide("retrieved_after", "same_pairs"), 6).alias("recall_after"),
    )


def base_rate(members: DataFrame, labelled: DataFrame) -> DataFrame:
    """How much denser in duplicates the labels are than the corpus; pairs are counted, not formed."""
    sizes = cluster_sizes(members).agg(
        F.sum("size").alias("n_notices"),
        F.sum(lsh.pairs_within(F.col("size"))).cast("double").alias("duplicate_pairs"),
    )
    labels = labelled.agg(
        F.struct(
            F.count("*").alias("n_labelled"), F.count_if(F.expr(SAME)).alias("n_same")
        ).alias("labels")
    )
    possible = lsh.pairs_within(F.col("n_notices")).cast("double")
    return sizes.select(
        "*",
        possible.alias("possible_pairs"),
        labels.scalar().alias("labels"),
    ).select(
        "n_notices",
        "duplicate_pairs",
        "possible_pairs",
        "labels.n_labelled",
        "labels.n_same",
        F.round(F.try_divide("duplicate_pairs", "possible_pairs"), 9).alias("corpus_rate"),
        F.round(F.try_divide("labels.n_same", "labels.n_labelled"), 9).alias("label_rate"),
    )


def pair_quality(members: DataFrame, labelled: DataFrame) -> DataFrame:
    """Precision and recall of the clusters themselves on labelled pairs."""
    owner = members.select("notice_id", "opportunity_id")
    judged = labelled.join(owner.toDF("notice_id_a", "opportunity_a"), "notice_id_a").join(
        owner.toDF("notice_id_b", "opportunity_b"), "notice_id_b"
    )
    together = F.col("opportunity_a") == F.col("opportunity_b")
    counts = judged.agg(
        F.count_if(F.expr(SAME) & together).alias("tp"),
        F.count_if(~F.expr(SAME) & together).alias("fp"),
        F.count_if(F.expr(SAME) & ~together).alias("fn"),
    )
    return counts.select(
        "*",
        F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 6).alias("precision"),
        F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6).alias("recall"),
    )
