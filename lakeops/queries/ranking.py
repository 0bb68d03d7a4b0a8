"""Ranking curves and sketches over scores of which no two are equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.operators import curves, sketches
from lakeops.plans import fixtures
from lakeops.queries.learning import _AP, _AUC, _QS, rounded
from lakeops.queries.oracle import CURVE, SCORED
from lakeops.queries.registry import add
from lakeops.sources.staging import stage

_FINE = f"WITH scored AS ({fixtures.duckdb_sql(fixtures.SCORED_FINE_SQL)})"
_FINE_CURVE = CURVE.replace(SCORED, _FINE)


def _rows(L):
    return fixtures.scored_fine(L.spark, L.sf_dir)


def _cumulative(L):
    return L.keep("fine-cumulative", lambda: stage(curves.cumulative_scores(curves.score_table(_rows(L))), "fine-cumulative"))


add(
    "pr_curve_continuous",
    lambda L: rounded(curves.pr_curve(_cumulative(L)), "precision", "recall"),
    _FINE_CURVE + " SELECT model_name, dataset_split, threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM curve",
)
add(
    "threshold_for_recall_continuous",
    lambda L: curves.threshold_for_recall(curves.pr_curve(_cumulative(L)).where(F.col("dataset_split") == K.VALIDATION)),
    _FINE_CURVE + " SELECT model_name, threshold FROM picked",
)
add(
    "average_precision_continuous",
    lambda L: rounded(curves.average_precision(_cumulative(L)), "average_precision"),
    _FINE_CURVE + f" SELECT model_name, dataset_split, round({_AP}, 9) AS average_precision FROM cum GROUP BY 1, 2",
)
add(
    "roc_auc_continuous",
    lambda L: rounded(curves.roc_auc(_cumulative(L)), "roc_auc"),
    _FINE_CURVE + f" SELECT model_name, dataset_split, round({_AUC}, 9) AS roc_auc FROM cum GROUP BY 1, 2",
)
add(
    "reliability_bins_continuous",
    lambda L: rounded(curves.reliability_bins(_cumulative(L)), "mean_predicted", "fraction_positive"),
    _FINE
    + f", edges AS (SELECT model_name, dataset_split, quantile_cont(probability, [{_QS}]) AS e FROM scored GROUP BY 1, 2)"
    + " SELECT model_name, dataset_split, CAST(len(list_filter(e, lambda x: x < probability)) AS INTEGER) AS bin,"
    + " count(*) AS row_count, round(avg(probability), 9) AS mean_predicted, round(avg(label), 9) AS fraction_positive"
    + " FROM scored JOIN edges USING (model_name, dataset_split) GROUP BY 1, 2, 3",
)


def _sketched(L):
    """Sketches of two halves of the rows, merged, whose results must hold the exact ones within their errors, and those must be small."""
    rows = _rows(L)
    merged = sketches.merge_sketches(*(sketches.score_sketch(rows.where(f"id % 3 {op} 0")) for op in ("=", "<>")))
    merged = stage(merged, "score-sketch")
    areas = sketches.sketched_areas(merged)
    bracket = sketches.sketched_recall_threshold(merged)
    reached = curves.pr_curve(_cumulative(L)).where(F.col("recall") >= K.RECALL_FLOOR)
    exact = curves.roc_auc(_cumulative(L)).withColumnRenamed("roc_auc", "auc")
    exact = exact.join(curves.average_precision(_cumulative(L)).withColumnRenamed("average_precision", "ap"), list(curves.GROUPS))
    exact = exact.join(reached.groupBy(*curves.GROUPS).agg(F.max("threshold").alias("largest")), list(curves.GROUPS))
    both = exact.join(areas, list(curves.GROUPS)).join(bracket, list(curves.GROUPS))
    slack = 1e-12
    return rounded(
        both.select(
            *curves.GROUPS,
            F.col("auc").alias("roc_auc"),
            F.col("ap").alias("average_precision"),
            F.col("largest").alias("recall_threshold"),
            (F.abs(F.col("roc_auc") - F.col("auc")) <= F.col("roc_auc_error") + slack).alias("auc_within"),
            (F.abs(F.col("average_precision") - F.col("ap")) <= F.col("average_precision_error") + slack).alias("ap_within"),
            (F.greatest("roc_auc_error", "average_precision_error") < 0.005).alias("errors_small"),
            ((F.col("low") <= F.col("largest")) & (F.col("largest") < F.col("high"))).alias("threshold_within"),
        ),
        "roc_auc", "average_precision",
    )


add(
    "score_sketch",
    _sketched,
    _FINE_CURVE
    + f", areas AS (SELECT model_name, dataset_split, round({_AUC}, 9) AS roc_auc, round({_AP}, 9) AS average_precision FROM cum GROUP BY 1, 2),"
    + " reached AS (SELECT model_name, dataset_split, max(threshold) AS recall_threshold FROM curve WHERE recall >= 0.75 GROUP BY 1, 2)"
    + " SELECT *, true AS auc_within, true AS ap_within, true AS errors_small, true AS threshold_within FROM areas JOIN reached USING (model_name, dataset_split)",
)
