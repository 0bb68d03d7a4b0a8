"""Fits read their rows, and searches fit their forests, no more often than needed."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.operators import models


@pytest.fixture(scope="module")
def train(spark):
    rows = spark.range(600).select(
        F.col("id").alias(K.ID), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11 / 10).alias("b"),
        (F.col("id") % 7 < 2).cast("int").alias(K.LABEL), F.lit(1.0).alias(K.WEIGHT),
    )
    return rows


def forest(**more):
    return models.Forest(**models._OUTPUTS, numTrees=4, maxDepth=3, **more)


def test_points_that_differ_in_trees_share_a_fit(train, monkeypatch):
    sizes, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (sizes.append(self.getNumTrees()), fit(self, df))[1])
    monkeypatch.setattr(models, "fit", lambda estimator, rows, columns: estimator)
    best, table = models.tune(forest(), {"numTrees": [2, 3, 5], "maxDepth": [1, 3]}, train, ["a", "b"], folds=2)
    assert sizes[:-1] == [5] * 4  # two depths on two folds, 12 fits before; the search itself fits its best point once more
    rows = table.collect()
    assert len(rows) == 6 and all(0 < r["average_precision"] <= 1 for r in rows)
    assert {(r["params"]["numTrees"], r["params"]["maxDepth"]) for r in rows} == {(t, d) for t in (2, 3, 5) for d in (1, 3)}


def test_the_smaller_forest_is_the_first_trees(train):
    rows = models.assemble(train, ["a", "b"])
    estimator = forest()
    points = [{estimator.numTrees: n} for n in (2, 5)]
    found = dict(estimator.fitMultiple(rows, points))
    shown = [[t.toDebugString.split("\n", 1)[1] for t in found[i].trees] for i in (0, 1)]
    assert [len(x) for x in shown] == [2, 5] and shown[0] == shown[1][:2]
    assert found[0].transform(rows).select(models.score_column().between(0, 1).alias("ok")).where("NOT ok").isEmpty()


def test_draws_read_written_vectors(spark, train, monkeypatch):
    """Columns were cut and assembled anew in every pass of every draw."""
    seen = []
    wanted = models.fit_forest
    monkeypatch.setattr(models, "fit_forest", lambda e, rows, keys: (seen.append(rows), wanted(e, rows, keys))[1])
    found = models.fit(forest(), train, ["a", "b"])
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "vectors-" in seen[0].inputFiles()[0] and "UDF" not in plan
    assert isinstance(found, PipelineModel) and found.transform(train).count() == 600
