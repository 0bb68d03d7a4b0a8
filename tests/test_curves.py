"""Curves, thresholds and bins against brute force in numpy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeops.operators import curves


def scored(spark, items, model="m"):
    rows = [(model, "TEST", float(p), int(y)) for p, y in items]
    return spark.createDataFrame(rows, "model_name string, dataset_split string, probability double, label int")


def cumulative(spark, items):
    return curves.cumulative_scores(curves.score_table(scored(spark, items)))


def brute_curve(items):
    p = np.array([a for a, _ in items], float)
    y = np.array([b for _, b in items])
    out = {}
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        out[t] = (y[hit].mean(), y[hit].sum() / y.sum() if y.sum() else 1.0)
    return out


ITEMS = st.lists(st.tuples(st.integers(0, 8).map(lambda k: k / 8), st.integers(0, 1)), min_size=2, max_size=40)
QUICK = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@QUICK
@given(ITEMS)
def test_curve_areas_and_threshold_equal_brute_force(spark, items):
    cum = cumulative(spark, items)
    expected = brute_curve(items)
    got = {r.threshold: (r.precision, r.recall) for r in curves.pr_curve(cum).collect()}
    assert set(got) == set(expected)
    for t in got:
        assert got[t] == pytest.approx(expected[t])

    last, ap = 0.0, 0.0
    for precision, recall in expected.values():
        ap += (recall - last) * precision
        last = recall
    has_positive = any(y for _, y in items)
    assert curves.average_precision(cum).first().average_precision == pytest.approx(ap if has_positive else 0.0)

    pos = [p for p, y in items if y]
    neg = [p for p, y in items if not y]
    auc = curves.roc_auc(cum).first().roc_auc
    if pos and neg:
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert auc == pytest.approx(wins / len(pos) / len(neg))
    else:
        assert auc is None

    feasible = {t: v for t, v in expected.items() if v[1] >= 0.75}
    best = max(feasible.items(), key=lambda kv: (kv[1][0], -kv[0]))[0]
    assert curves.threshold_for_recall(curves.pr_curve(cum)).first().threshold == best


def test_separable_scores_meet_the_floor(spark):
    items = list(zip(np.linspace(0, 0.4, 50), [0] * 50)) + list(zip(np.linspace(0.6, 1, 50), [1] * 50))
    threshold = curves.threshold_for_recall(curves.pr_curve(cumulative(spark, items))).first().threshold
    hit = [y for p, y in items if p >= threshold]
    assert sum(hit) / 50 >= 0.75 and min(hit) == 1
    assert threshold == pytest.approx(0.6)


def test_weak_scores_fall_back_to_catching_everything(spark):
    items = [(0.9, 0), (0.8, 0), (0.7, 1), (0.1, 1)]
    curve = curves.pr_curve(cumulative(spark, items))
    assert curves.threshold_for_recall(curve, floor=0.99).first().threshold == 0.1


def test_unreachable_floor_takes_the_highest_recall(spark):
    curve = spark.createDataFrame(
        [("m", 0.9, 0.5, 0.2), ("m", 0.4, 0.3, 0.6), ("m", 0.2, 0.2, 0.6)],
        "model_name string, threshold double, precision double, recall double",
    )
    assert curves.threshold_for_recall(curve).first().threshold == 0.2


def test_metrics_are_zero_not_an_error_without_predicted_positives(spark):
    cum = cumulative(spark, [(0.1, 0), (0.2, 1), (0.3, 0)])
    thresholds = spark.createDataFrame([("m", 0.9)], "model_name string, threshold double")
    row = curves.binary_metrics(cum, thresholds, ["x"]).first()
    assert (row.precision, row.recall, row.f2_score) == (0.0, 0.0, 0.0)
    assert (row.true_negative_count, row.false_negative_count) == (2, 1)
    assert (row.feature_count, row.label_column_count, row.selected_features) == (1, 1, "x")


def test_decision_is_at_or_above_the_threshold(spark):
    scores = curves.score_table(scored(spark, [(0.5, 1), (0.5, 0), (0.4, 1)]))
    thresholds = spark.createDataFrame([("m", 0.5)], "model_name string, threshold double")
    row = curves.confusion_counts(scores, thresholds).first()
    assert (row.true_positive_count, row.false_positive_count, row.false_negative_count) == (1, 1, 1)


@QUICK
@given(ITEMS)
def test_bins_equal_numpy_quantiles(spark, items):
    p = np.array([a for a, _ in items])
    y = np.array([b for _, b in items])
    cum = cumulative(spark, items)
    edges = np.quantile(p, [i / 10 for i in range(1, 10)])
    assert curves.quantile_edges(cum).first().edges == pytest.approx(list(edges))
    got = {r.bin: (r.row_count, r.mean_predicted, r.fraction_positive) for r in curves.reliability_bins(cum).collect()}
    assert sum(n for n, _, _ in got.values()) == len(items)
    assert sum(n * f for n, _, f in got.values()) == pytest.approx(y.sum())
