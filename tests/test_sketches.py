"""Score sketches against exact curves: results within their errors, whatever the scores and however the rows are parted."""

import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import curves, sketches

G = ("model_name",)


def scored(spark, rows):
    return spark.createDataFrame(rows, "model_name string, probability double, label int")


def some(seed, n, digits):
    r = random.Random(seed)
    scores = [round(r.random() ** 3, digits) for _ in range(n)]
    return [(f"m{k % 2}", s, int(r.random() < s * 0.6)) for k, s in enumerate(scores)]


def results(spark, rows, cells):
    df = scored(spark, rows)
    cumulative = curves.cumulative_scores(curves.score_table(df, G), G)
    auc = {r[0]: r[1] for r in curves.roc_auc(cumulative, G).collect()}
    ap = {r[0]: r[1] for r in curves.average_precision(cumulative, G).collect()}
    sketch = sketches.score_sketch(df, cells, G)
    return auc, ap, {r["model_name"]: r for r in sketches.sketched_areas(sketch, G).collect()}


@pytest.mark.parametrize("cells", [1, 7, 64, 4096])
@pytest.mark.parametrize("digits", [1, 3, 12])
def test_exact_areas_lie_within_the_errors(spark, cells, digits):
    auc, ap, found = results(spark, some(cells + digits, 600, digits), cells)
    for m, r in found.items():
        assert abs(r["roc_auc"] - auc[m]) <= r["roc_auc_error"] + 1e-12
        assert abs(r["average_precision"] - ap[m]) <= r["average_precision_error"] + 1e-12


def test_errors_vanish_with_many_cells(spark):
    _, _, found = results(spark, some(5, 400, 12), 1 << 20)
    assert all(r["roc_auc_error"] < 1e-4 and r["average_precision_error"] < 0.01 for r in found.values())


def test_sketches_of_parts_add_up(spark):
    rows = some(3, 500, 12)
    parts = [sketches.score_sketch(scored(spark, rows[k::3]), 50, G) for k in range(3)]
    merged = sketches.merge_sketches(sketches.merge_sketches(*parts[:2], G), parts[2], G)
    whole = sketches.score_sketch(scored(spark, rows), 50, G)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.count() <= 2 * 50


@pytest.mark.parametrize("floor", [0.1, 0.75, 1.0])
def test_the_recall_threshold_lies_in_its_cell(spark, floor):
    df = scored(spark, some(9, 500, 12))
    curve = curves.pr_curve(curves.cumulative_scores(curves.score_table(df, G), G), G)
    exact = {r[0]: r[1] for r in curve.where(F.col("recall") >= floor).groupBy("model_name").agg(F.max("threshold")).collect()}
    for r in sketches.sketched_recall_threshold(sketches.score_sketch(df, 100, G), floor, 100, G).collect():
        assert r["low"] <= exact[r["model_name"]] < r["high"]


def test_one_class_no_score_and_scores_outside(spark):
    rows = [("all", 0.5, 1), ("all", 2.0, 1), ("none", -1.0, 0), ("none", None, 1), ("none", 1.0, 0)]
    found = {r["model_name"]: r for r in sketches.sketched_areas(sketches.score_sketch(scored(spark, rows), 10, G), G).collect()}
    assert found["all"]["roc_auc"] is None and found["none"]["roc_auc"] is None
    assert abs(found["all"]["average_precision"] - 1) <= found["all"]["average_precision_error"] + 1e-12
    assert found["none"]["average_precision"] == 0
    assert sketches.sketched_areas(sketches.score_sketch(scored(spark, []), 10, G), G).collect() == []
