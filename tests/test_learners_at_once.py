"""Learners are fitted side by side, as far as their rows fit in memory together."""

import threading

import pytest
from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.operators import models as M
from lakeops.plans import training
from lakeops.sources.staging import fresh_path, tidied


@pytest.fixture(scope="module")
def encoded(spark):
    inputs = [(F.xxhash64("id", F.lit(c)) % 5).cast("double").alias(c) for c in K.MODEL_INPUTS]
    label = (F.pmod(F.xxhash64("id", F.lit("label")), F.lit(4)) == 0).cast("int").alias(K.LABEL)
    split = F.when(F.col("id") % 10 < 7, K.TRAIN).when(F.col("id") % 10 == 7, K.TEST).otherwise(K.VALIDATION).alias(K.SPLIT)
    report = [F.lit("x").alias(c) for c in K.REPORT_COLUMNS if c != K.ID]
    rows = spark.range(900).select(F.col("id").alias(K.ID), *inputs, label, split, F.lit(1.0).alias(K.WEIGHT), *report)
    return training.Encoded(training.stage(rows, "encoded"), rows, rows)


@pytest.fixture(scope="module")
def importances(spark):
    return M.importance_table(spark, K.MODEL_INPUTS, [0.1] * len(K.MODEL_INPUTS))


def test_learners_are_fitted_at_once(encoded, importances, monkeypatch):
    """They were fitted one after the other, so the first one waited in vain."""
    met, fit = threading.Barrier(2, timeout=30), M.fit_and_calibrate
    monkeypatch.setattr(M, "fit_and_calibrate", lambda *a: (met.wait(), fit(*a))[1])
    found = training.train(encoded, (M.FOREST, M.TREE), importances=importances)
    assert [m.name for m in found.models] == [M.FOREST, M.TREE]
    for m in found.models:
        alone = fit(m.name, M.estimators()[m.name], encoded.rows, found.selected)
        shown = [x.base.stages[-1].toDebugString.split("\n", 1)[1] for x in (m, alone)]
        assert shown[0] == shown[1]
        assert list(m.model.stages[-1].coefficients) == list(alone.model.stages[-1].coefficients)
    assert found.predictions.groupBy("model_name").count().collect() and found.predictions.count() == 180


def test_many_rows_are_fitted_one_learner_at_a_time(encoded, monkeypatch):
    monkeypatch.setattr(M, "ROWS_AT_ONCE", 629)
    seen = []
    rows = encoded.rows.where(F.col(K.SPLIT) == K.TRAIN)
    assert training.side_by_side(lambda n: (seen.append(threading.current_thread()), n)[1], ["b", "a"], rows) == ["b", "a"]
    assert set(seen) == {threading.main_thread()}


def test_what_learners_stage_is_tidied_up(spark, encoded):
    def fit(name):
        path = fresh_path(spark, name)
        spark.range(3).write.parquet(path)
        return path

    with tidied(spark):
        paths = training.side_by_side(fit, ["a", "b"], encoded.rows)
        assert [spark.read.parquet(p).count() for p in paths] == [3, 3]
    assert not any(held(spark, p) for p in paths)


def held(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
