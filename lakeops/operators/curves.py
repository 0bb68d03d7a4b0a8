"""Ranking curves, thresholds and metrics of scored rows, exact and distributed.

Everything starts from the score table: rows and positives per (group, score). It is what makes
a hot score value one row, and every curve, threshold, area and bin below needs nothing else.
Per-group results that are joined back (thresholds, bin edges) are written first, so the
optimizer sees from the file how small they are. Ratios are computed in double: dividing a bigint by a literal 2.0 would give a rounded decimal.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.constants import DEFAULT_THRESHOLD, RECALL_FLOOR
from lakeops.operators.scan import prefix_scan
from lakeops.sources.staging import stage

GROUPS = ("model_name", "dataset_split")


def score_table(
    scored: DataFrame, groups: Iterable[str] = GROUPS, score: str = "probability", label: str = "label"
) -> DataFrame:
    """Rows and positives per distinct score of every group."""
    return scored.groupBy(*groups, F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label)).cast("bigint").alias("pos")
    )


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` in double, null when ``b`` is zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def cumulative_scores(scores: DataFrame, groups: Iterable[str] = GROUPS) -> DataFrame:
    """The score table with, per score, rows and positives at or above it, and group totals."""
    return prefix_scan(
        scores,
        [F.col("score").desc()],
        {"cum_n": "n", "cum_pos": "pos"},
        groups,
        {"total_n": "cum_n", "total_pos": "cum_pos"},
    )


def pr_curve(cumulative: DataFrame, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Precision and recall when calling every score at or above ``threshold`` positive."""
    recall = F.coalesce(ratio(F.col("cum_pos"), F.col("total_pos")), F.lit(1.0))
    return cumulative.select(
        *groups,
        F.col("score").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
        recall.alias("recall"),
    )


def threshold_for_recall(
    curve: DataFrame,
    groups: Iterable[str] = ("model_name",),
    floor: float = RECALL_FLOOR,
    default: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Per group, the threshold of highest precision whose recall reaches ``floor``.

    Ties go to the lowest threshold. Where no threshold reaches the floor, the one of highest
    recall is taken (ties again to the lowest), and ``default`` where there is none at all.
    """
    low_first = -F.col("threshold")
    feasible = F.when(F.col("recall") >= floor, F.struct(F.col("precision"), low_first))
    fallback = F.struct(F.col("recall"), low_first)
    best = F.coalesce(
        F.max_by("threshold", feasible), F.max_by("threshold", fallback), F.lit(default)
    )
    return curve.groupBy(*groups).agg(best.alias("threshold"))


def average_precision(cumulative: DataFrame, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Step-wise area under the precision-recall curve; 0 without positives.

    A score's recall step is its own positives over all positives, so no lag is needed.
    """
    step = ratio(F.col("pos"), F.col("total_pos")) * ratio(F.col("cum_pos"), F.col("cum_n"))
    return cumulative.groupBy(*groups).agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"))


def _auc() -> Column:
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    total_neg = F.col("total_n") - F.col("total_pos")
    below = total_neg - (F.col("cum_n") - F.col("cum_pos"))
    pairs = F.sum(pos.cast("double") * (below.cast("double") + neg.cast("double") * 0.5))
    all_pairs = F.max(F.col("total_pos").cast("double") * total_neg.cast("double"))
    return pairs / F.nullif(all_pairs, F.lit(0.0))


def roc_auc(cumulative: DataFrame, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; null for one class."""
    return cumulative.groupBy(*groups).agg(_auc().alias("roc_auc"))


def _confusion(predicted: Column) -> list[Column]:
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    zero = F.lit(0)
    return [
        F.sum(F.when(predicted, pos).otherwise(zero)).alias("true_positive_count"),
        F.sum(F.when(predicted, neg).otherwise(zero)).alias("false_positive_count"),
        F.sum(F.when(predicted, zero).otherwise(neg)).alias("true_negative_count"),
        F.sum(F.when(predicted, zero).otherwise(pos)).alias("false_negative_count"),
    ]


def confusion_counts(
    scores: DataFrame, thresholds: DataFrame, groups: Iterable[str] = GROUPS, by: Iterable[str] = ("model_name",)
) -> DataFrame:
    """Confusion counts per group; a row is called positive when its score reaches the threshold."""
    joined = scores.join(stage(thresholds, "thresholds"), list(by))
    return joined.groupBy(*groups).agg(*_confusion(F.col("score") >= F.col("threshold")))


def binary_metrics(
    cumulative: DataFrame,
    thresholds: DataFrame,
    selected_features: Iterable[str] = (),
    groups: Iterable[str] = GROUPS,
    by: Iterable[str] = ("model_name",),
) -> DataFrame:
    """The metrics row of every model and split, from one aggregate over the score table."""
    selected = list(selected_features)
    step = ratio(F.col("pos"), F.col("total_pos")) * ratio(F.col("cum_pos"), F.col("cum_n"))
    base = (
        cumulative.join(stage(thresholds, "thresholds"), list(by))
        .groupBy(*groups)
        .agg(
            F.sum("n").alias("row_count"),
            F.sum("pos").alias("_pos"),
            _auc().alias("auc_roc"),
            F.coalesce(F.sum(step), F.lit(0.0)).alias("auc_pr"),
            F.max("threshold").alias("selected_threshold"),
            *_confusion(F.col("score") >= F.col("threshold")),
        )
    )
    tp, fp, fn = (F.col(f"{k}_count") for k in ("true_positive", "false_positive", "false_negative"))
    return base.select(
        *groups,
        "row_count",
        "auc_roc",
        "auc_pr",
        F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(ratio(tp * 5, tp * 5 + fn * 4 + fp), F.lit(0.0)).alias("f2_score"),
        "selected_threshold",
        "true_positive_count",
        "false_positive_count",
        "true_negative_count",
        "false_negative_count",
        ratio(F.col("_pos"), F.col("row_count")).alias("positive_label_rate"),
        ratio(tp + fp, F.col("row_count")).alias("predicted_positive_rate"),
        F.lit(len(selected)).alias("feature_count"),
        F.lit(1).alias("label_column_count"),
        F.lit(", ".join(selected)).alias("selected_features"),
    )


def quantile_edges(cumulative: DataFrame, bins: int = 10, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Inner quantile edges of every group's scores, linearly interpolated, as an array.

    An exact percentile aggregate would hold all scores of a group in one task. Here every score
    looks up which of the few wanted ranks fall on it, from its running row count.
    """
    groups = list(groups)
    cum, total = F.col("cum_n"), F.col("total_n")
    first_rank, last_rank = total - cum, total - cum + F.col("n") - 1
    wanted = F.array(*[F.struct(F.lit(i).alias("edge"), F.lit(i / bins).alias("q")) for i in range(1, bins)])
    place = (total - 1).cast("double")

    def hit(e: Column) -> Column:
        exact = e["q"] * place
        return (F.floor(exact) <= last_rank) & (F.ceil(exact) >= first_rank)

    hits = cumulative.select(
        *groups, "score", F.explode(F.filter(wanted, hit)).alias("e"),
        first_rank.alias("first"), last_rank.alias("last"), place.alias("place"),
    )
    exact = F.col("e.q") * F.col("place")
    low = F.max(F.when(F.floor(exact).between(F.col("first"), F.col("last")), F.col("score")))
    high = F.max(F.when(F.ceil(exact).between(F.col("first"), F.col("last")), F.col("score")))
    edges = hits.groupBy(*groups, F.col("e.edge").alias("edge")).agg(
        (low + (high - low) * F.max(exact - F.floor(exact))).alias("value")
    )
    return edges.groupBy(*groups).agg(
        F.array_sort(F.collect_list(F.struct("edge", "value"))).getField("value").alias("edges")
    )


def reliability_bins(cumulative: DataFrame, bins: int = 10, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Mean score against share of positives in quantile bins (the number of inner edges below)."""
    groups = list(groups)
    edges = stage(quantile_edges(cumulative, bins, groups), "edges")
    bin_no = F.size(F.filter(F.col("edges"), lambda e: e < F.col("score")))
    return (
        cumulative.join(edges, groups)
        .groupBy(*groups, bin_no.alias("bin"))
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(F.col("n") * F.col("score")).alias("_mass"),
            F.sum("pos").alias("_pos"),
        )
        .select(
            *groups,
            "bin",
            "row_count",
            ratio(F.col("_mass"), F.col("row_count")).alias("mean_predicted"),
            ratio(F.col("_pos"), F.col("row_count")).alias("fraction_positive"),
        )
    )
