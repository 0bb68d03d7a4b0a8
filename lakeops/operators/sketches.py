"""Score sketches: areas and thresholds of any number of scored rows in one pass, with bounds on their error.

A sketch counts rows and positives in cells of equal width over [0, 1]. Sketches of parts of the rows add up, so a task sends at most a row per group and
cell, and nothing is sorted. What is lost is the order within a cell; every result says how much that can change it. ``curves.py`` has the exact
results, which sort the distinct scores.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.constants import RECALL_FLOOR
from lakeops.operators.curves import GROUPS, ratio

CELLS = 4096


def score_sketch(
    scored: DataFrame, cells: int = CELLS, groups: Iterable[str] = GROUPS, score: str = "probability", label: str = "label"
) -> DataFrame:
    """Rows (``n``) and positives (``pos``) per group and ``cell``; rows without a score don't count, scores outside [0, 1] go to the cells at the ends."""
    cell = F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor(F.col(score) * cells))).cast("int")
    rows = scored.where(F.col(score).isNotNull())
    return rows.groupBy(*groups, cell.alias("cell")).agg(F.count("*").alias("n"), F.sum(F.col(label)).cast("bigint").alias("pos"))


def merge_sketches(a: DataFrame, b: DataFrame, groups: Iterable[str] = GROUPS) -> DataFrame:
    """The sketch of the rows of both."""
    return a.unionByName(b).groupBy(*groups, "cell").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def _above(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Cells with what lies above them, and the totals; a window sees no more rows than there are cells."""
    higher = Window.partitionBy(*groups).orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    sums = {f"above_{c}": F.coalesce(F.sum(c).over(higher), F.lit(0)) for c in ("n", "pos")}
    return sketch.withColumns(sums | {f"total_{c}": F.sum(c).over(whole) for c in ("n", "pos")})


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def sketched_areas(sketch: DataFrame, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Per group ``roc_auc`` and ``average_precision``, each within its ``_error`` of the exact one; an area is null where the exact one is.

    Pairs of a positive and a negative of one cell may stand either way, so AUC lies within half of them. A positive's precision is lowest
    if all negatives of its cell come first, and highest if none does.
    """
    groups = list(groups)
    n, pos, above_n, above_pos = (_double(c) for c in ("n", "pos", "above_n", "above_pos"))
    neg = n - pos
    positives, negatives = F.max(_double("total_pos")), F.max(_double("total_n") - _double("total_pos"))
    below = (_double("total_n") - _double("total_pos")) - (above_n - above_pos) - neg
    all_pairs = F.nullif(positives * negatives, F.lit(0.0))
    low = F.when(pos > 0, pos * (above_pos + 1) / (above_n + neg + 1)).otherwise(0.0)
    high = F.when(pos > 0, pos * (above_pos + pos) / (above_n + pos)).otherwise(0.0)
    sums = _above(sketch, groups).groupBy(*groups).agg(
        (F.sum(pos * (below + neg / 2)) / all_pairs).alias("roc_auc"),
        (F.sum(pos * neg / 2) / all_pairs).alias("roc_auc_error"),
        F.coalesce(F.sum(low) / F.nullif(positives, F.lit(0.0)), F.lit(0.0)).alias("_low"),
        F.coalesce(F.sum(high) / F.nullif(positives, F.lit(0.0)), F.lit(0.0)).alias("_high"),
    )
    middle, half = (F.col("_low") + F.col("_high")) / 2, (F.col("_high") - F.col("_low")) / 2
    return sums.select(*groups, "roc_auc", "roc_auc_error", middle.alias("average_precision"), half.alias("average_precision_error"))


def sketched_recall_threshold(sketch: DataFrame, floor: float = RECALL_FLOOR, cells: int = CELLS, groups: Iterable[str] = GROUPS) -> DataFrame:
    """Per group ``low`` and ``high``: the largest threshold whose recall reaches ``floor`` is at least the one and below the other (at most 1 in the last cell)."""
    groups = list(groups)
    reached = ratio(F.col("above_pos") + F.col("pos"), F.col("total_pos")) >= floor
    cell = F.max(F.when(reached, F.col("cell")))
    found = _above(sketch, groups).groupBy(*groups).agg(cell.alias("cell"))
    return found.select(*groups, (F.col("cell") / cells).alias("low"), ((F.col("cell") + 1) / cells).alias("high"))
