"""Trees and forests grown over blocks, each tree by one task: the library's trees, and what a search shares."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from lakeops.constants import LABEL, WEIGHT
from lakeops.operators import growing
from lakeops.operators import models as M

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))
    df = spark.range(6000).select(F.col("id").alias("complaint_id"), (h("a", 20) / 20).alias("a"), (h("b", 13) * 1.0).alias("b"), h("c", 2).cast("int").alias("c"), (h("d", 30) * 1.0).alias("d"))
    label = (F.col("a") + F.col("b") / 13 + F.col("c") * 0.3 + F.pmod(F.xxhash64(F.lit("e"), "complaint_id"), F.lit(100)) / 100.0 > 1.8).cast("int")
    return M.stage(df.withColumn(LABEL, label).withColumn(WEIGHT, F.when(F.col(LABEL) == 1, 3.25).otherwise(1.0)), "rows")


def text(model):
    return model.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("more", [{"maxDepth": 6, "minInstancesPerNode": 20}, {"maxDepth": 12}, {"maxDepth": 0}, {"maxDepth": 4, "minInfoGain": 0.01, "minWeightFractionPerNode": 0.05}])
def test_a_tree_is_the_librarys(rows, more):
    ready = M.assemble(rows, COLUMNS)
    wanted, found = (kind(**M._OUTPUTS, **more).fit(ready) for kind in (DecisionTreeClassifier, M.Tree))
    assert text(found) == text(wanted) and found.depth == wanted.depth
    assert np.allclose(found.featureImportances.toArray(), wanted.featureImportances.toArray())
    a, b = ([r[0] for r in m.transform(ready).orderBy("complaint_id").select(M.score_column()).collect()] for m in (wanted, found))
    assert np.allclose(a, b) and found.getProbabilityCol() == "tree_probability"


def test_depths_of_a_grid_share_their_trees(rows, monkeypatch):
    """Every depth was a fit of its own."""
    seen, fit = [], growing.fit_trees
    monkeypatch.setattr(growing, "fit_trees", lambda spark, plan, trees, files: (seen.append((plan.depth, trees)), fit(spark, plan, trees, files))[1])
    ready = M.assemble(rows, COLUMNS)
    estimator = M.Forest(**M._OUTPUTS, minInstancesPerNode=5)
    points = [{estimator.numTrees: n, estimator.maxDepth: d} for n in (2, 5) for d in (3, 7)]
    found = dict(estimator.fitMultiple(ready, points))
    assert seen == [(7, 5)]
    for i, point in enumerate(points):
        alone = estimator.fit(ready, point)
        assert [text(t) for t in found[i].trees] == [text(t) for t in alone.trees]
        assert found[i].getNumTrees == point[estimator.numTrees] and max(t.depth for t in found[i].trees) <= point[estimator.maxDepth]
    assert len(seen) == 5


def test_depths_of_a_tree_are_its_own_fits(rows):
    ready = M.assemble(rows, COLUMNS)
    estimator = M.Tree(**M._OUTPUTS)
    points = [{estimator.maxDepth: d, estimator.minInstancesPerNode: n} for d in (2, 6) for n in (1, 40)]
    for i, model in estimator.fitMultiple(ready, points):
        assert text(model) == text(DecisionTreeClassifier(**M._OUTPUTS, **{p.name: v for p, v in points[i].items()}).fit(ready))


def test_jobs_do_not_grow_with_depth_or_trees(spark, rows):
    """A level of every group of trees was a job."""
    sc, jobs = spark.sparkContext, []
    for n, (trees, depth) in enumerate(((2, 2), (20, 8))):
        sc.setJobGroup(f"grown-{n}", "")
        M.fit(RandomForestClassifier(**M._OUTPUTS, numTrees=trees, maxDepth=depth), rows, COLUMNS)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"grown-{n}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert abs(jobs[0] - jobs[1]) <= 2


def test_draws_are_taken_in_turn_and_nodes_draw_inputs(rows):
    found = M.fit(RandomForestClassifier(**M._OUTPUTS, numTrees=10, maxDepth=4), rows, COLUMNS).stages[-1]
    assert len({text(t) for t in found.trees}) == 10  # eight draws, so trees 0 and 8 share rows, but not inputs
    few = M.fit(RandomForestClassifier(**M._OUTPUTS, numTrees=10, maxDepth=1, featureSubsetStrategy="1"), rows, COLUMNS).stages[-1]
    assert len({t.toDebugString.split("feature ")[1].split(" ")[0] for t in few.trees if t.depth}) > 1


def test_more_rows_are_left_to_the_library(rows, monkeypatch):
    monkeypatch.setattr(growing, "MOST_ROWS", 5999)
    monkeypatch.setattr(growing, "fit_trees", None)
    assert M.fit(M.Forest(**M._OUTPUTS, numTrees=9, maxDepth=2), rows, COLUMNS).stages[-1].getNumTrees == 9
    assert M.fit(M.Tree(**M._OUTPUTS, maxDepth=2), rows, COLUMNS).stages[-1].depth == 2
    assert M.Forest(**M._OUTPUTS, numTrees=3, maxDepth=2).fit(M.assemble(rows, COLUMNS)).getNumTrees == 3


def test_one_class_and_null_labels(rows):
    found = M.fit(M.Tree(**M._OUTPUTS), rows.withColumn(LABEL, F.lit(1)), COLUMNS).stages[-1]
    assert found.depth == 0
    with pytest.raises(Exception, match="null"):
        M.fit(M.Tree(**M._OUTPUTS), rows.withColumn(LABEL, F.when(F.col("complaint_id") != 7, F.col(LABEL))), COLUMNS)


@pytest.mark.parametrize("kind", [M.Tree, M.Forest])
def test_a_search_scores_its_points_as_their_models_do(rows, kind):
    """Each point was scored by a model of its own."""
    grid = {"maxDepth": [2, 6]} | ({"numTrees": [2, 5]} if kind is M.Forest else {"minInstancesPerNode": [50]})
    estimator = kind(**M._OUTPUTS)
    _, table = M.tune(estimator, grid, rows, COLUMNS, folds=2)
    dealt = M.assemble(M.with_folds(rows, COLUMNS, 2), COLUMNS)
    assert table.count() == (4 if kind is M.Forest else 2)
    for r in table.collect()[::3]:
        point = {estimator.getParam(n): int(v) for n, v in r["params"].items()}
        folds = [M.AveragePrecision().evaluate(estimator.fit(dealt.where(F.col(M.FOLD) != k), point).transform(dealt.where(F.col(M.FOLD) == k))) for k in (0, 1)]
        assert r["average_precision"] == pytest.approx(np.mean(folds), abs=1e-9)


def test_a_search_grows_a_forest_per_fold(rows, monkeypatch):
    """It grew one for each depth and fold, and one that nothing read."""
    seen, fit = [], growing.fit_trees
    monkeypatch.setattr(growing, "fit_trees", lambda spark, plan, trees, files: (seen.append((plan.depth, trees)), fit(spark, plan, trees, files))[1])
    M.tune(M.Forest(**M._OUTPUTS), {"numTrees": [2, 3], "maxDepth": [1, 3]}, rows, COLUMNS, folds=3)
    assert seen[:3] == [(3, 3)] * 3 and len(seen) == 4


def test_a_search_among_more_rows_is_the_librarys(rows, monkeypatch):
    monkeypatch.setattr(growing, "MOST_ROWS", 100)
    _, table = M.tune(M.Forest(**M._OUTPUTS), {"numTrees": [2, 3], "maxDepth": [1, 3]}, rows, COLUMNS, folds=2)
    assert len(table.where("average_precision > 0.3").collect()) == 4
