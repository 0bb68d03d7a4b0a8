"""Trees and forests that depend on the rows alone: hashed draws, exact bins, exact sums."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from lakeops.constants import LABEL, WEIGHT
from lakeops.operators import models as M

#: Above the rows from which the learner samples its split candidates.
ROWS = 15_000
SETTINGS = {"maxDepth": 5, "minInstancesPerNode": 5}


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1000)) / 1000.0
    df = spark.range(ROWS).select(F.col("id").alias("complaint_id"), (h("a") * h("b")).alias("a"), h("c").alias("b"), F.floor(h("d") * 7).cast("int").alias("day"), F.lit(3.5).alias("same"))
    score = F.col("a") * 2 + F.col("b") + (F.col("day") == 3).cast("int")
    label = (score + F.pmod(F.xxhash64(F.lit("e"), "complaint_id"), F.lit(100)) / 100.0 > 2.0).cast("int")
    df = df.withColumn(LABEL, label).withColumn(WEIGHT, F.when(F.col(LABEL) == 1, 3.3333333).otherwise(1.0))
    df = M.stage(df, "rows")
    df.count()
    return df


COLUMNS = ["a", "b", "day", "same"]


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_equal_models_in_any_number_of_partitions(rows, kind):
    def learner():
        if kind == "tree":
            return DecisionTreeClassifier(**M._OUTPUTS, **SETTINGS)
        return RandomForestClassifier(**M._OUTPUTS, **SETTINGS, numTrees=6)

    fitted = [M.fit(learner(), rows.repartition(n), COLUMNS).stages[-1] for n in (1, 4, 50)]
    # a model's text without its name
    texts = [m.toDebugString.split("\n", 1)[1] for m in fitted]
    assert texts[0] == texts[1] == texts[2] and texts[0].count("If") > 8
    importances = [m.featureImportances.toArray().tolist() for m in fitted]
    assert importances[0] == importances[1] == importances[2]
    assert math.isclose(sum(importances[0]), 1.0) and importances[0][3] == 0.0


def test_a_forest_of_groups_is_one_model(rows, tmp_path):
    model = M.fit(RandomForestClassifier(**M._OUTPUTS, **SETTINGS, numTrees=11), rows, COLUMNS)
    forest = model.stages[-1]
    assert forest.getNumTrees == 11 and len(set(t.toDebugString for t in forest.trees)) > 8
    # its probability is the mean of its trees'
    ready = PipelineModel(model.stages[:-1]).transform(rows.limit(50))
    vectors = [r["features"] for r in ready.select("features").collect()]
    for v in vectors[:10]:
        want = np.mean([t.predictProbability(v).toArray() for t in forest.trees], axis=0)
        assert np.allclose(forest.predictProbability(v).toArray(), want)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    score = M.score_column()
    a, b = (sorted(r[0] for r in m.transform(rows).select(score).collect()) for m in (model, again))
    assert a == b and len(set(a)) > 50


def test_draws_are_poisson_and_differ(rows):
    counts = rows.select(*[M.bag_count(k, ["complaint_id"]).alias(f"b{k}") for k in range(3)])
    shares = {r["b0"]: r["count"] / ROWS for r in counts.groupBy("b0").count().collect()}
    for k in range(4):
        assert abs(shares[k] - math.exp(-1) / math.factorial(k)) < 0.015
    assert abs(counts.corr("b0", "b1")) < 0.03 and abs(counts.agg(F.avg("b2")).first()[0] - 1) < 0.03
    again = rows.repartition(9).select("complaint_id", M.bag_count(0, ["complaint_id"]).alias("k"))
    assert sorted(again.collect()) == sorted(rows.select("complaint_id", M.bag_count(0, ["complaint_id"]).alias("k")).collect())


def test_bins_hold_values_or_equal_shares(rows):
    a, b, day, same = M.bin_edges(rows, COLUMNS, 16)
    assert day == [-math.inf, 0.5, 1.5, 2.5, 3.5, 4.5, 5.5, math.inf]
    assert same == [-math.inf, 0.0, math.inf]
    assert len(a) == len(b) == 17
    for column, edges in (("a", a), ("b", b)):
        sizes = [rows.where((F.col(column) >= lo) & (F.col(column) < hi)).count() for lo, hi in zip(edges, edges[1:])]
        assert sum(sizes) == ROWS and max(sizes) < 1.3 * ROWS / 16


def test_sums_of_weights_are_exact(rows):
    held, _ = M.learning_rows(rows, COLUMNS)
    values = [r[0] for r in held.select(WEIGHT).distinct().collect()]
    assert all((v * M.WEIGHT_STEPS).is_integer() for v in values) and len(values) == 2
    assert max(abs(v - 3.3333333) for v in values if v > 1) < 1 / M.WEIGHT_STEPS


def test_rows_without_an_id(rows):
    fitted = [M.fit(RandomForestClassifier(**M._OUTPUTS, **SETTINGS, numTrees=4), rows.drop("complaint_id").repartition(n), COLUMNS).stages[-1].toDebugString.split("\n", 1)[1] for n in (1, 7)]
    assert fitted[0] == fitted[1]
