"""The boosted learner over blocks: the library's trees, whatever the layout, without a job per level where one task holds the rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from lakeops.constants import LABEL, WEIGHT
from lakeops.operators import boosting
from lakeops.operators import models as M

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))
    df = spark.range(3000).select(F.col("id").alias("complaint_id"), (h("a", 20) / 20).alias("a"), (h("b", 13) * 1.0).alias("b"), h("c", 2).cast("int").alias("c"))
    label = (F.col("a") + F.col("b") / 13 + F.col("c") * 0.3 + F.pmod(F.xxhash64(F.lit("e"), "complaint_id"), F.lit(100)) / 100.0 > 1.8).cast("int")
    df = df.withColumn(LABEL, label).withColumn(WEIGHT, F.when(F.col(LABEL) == 1, 3.25).otherwise(1.0))
    return M.stage(df, "rows")


def learner(kind=M.Boosted, **more):
    settings = {k: v for k, v in M._OUTPUTS.items() if not k.startswith(("prob", "raw"))} | {"maxIter": 6, "maxDepth": 3, "stepSize": 0.1} | more
    return kind(**settings).setProbabilityCol("tree_probability").setRawPredictionCol("tree_raw")


def text(model):
    return model.stages[-1].toDebugString.split("\n", 1)[1]


DRAWN = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}


def test_scores_and_importances_are_the_librarys(rows):
    ready = M.assemble(rows, COLUMNS)
    wanted = learner(GBTClassifier).fit(ready)
    found = M.fit(learner(), rows, COLUMNS).stages[-1]
    assert found.treeWeights == wanted.treeWeights and found.totalNumNodes == wanted.totalNumNodes
    assert np.allclose(found.featureImportances.toArray(), wanted.featureImportances.toArray(), atol=1e-5)
    a, b = ([r[0] for r in m.transform(ready).orderBy("complaint_id").select(M.score_column()).collect()] for m in (wanted, found))
    assert np.allclose(a, b, atol=1e-5) and len(set(np.round(b, 6))) > 50


def test_least_rows_of_a_node_are_the_librarys(rows):
    ready = M.assemble(rows, COLUMNS)
    settings = {"maxIter": 2, "maxDepth": 5, "minInstancesPerNode": 200}
    wanted, found = learner(GBTClassifier, **settings).fit(ready), M.fit(learner(**settings), rows, COLUMNS).stages[-1]
    assert found.totalNumNodes == wanted.totalNumNodes < 60
    assert np.allclose(found.featureImportances.toArray(), wanted.featureImportances.toArray(), atol=1e-5)


def test_equal_models_in_any_layout_and_by_one_task_or_many(rows, monkeypatch):
    """The library draws rows per partition; two fits differed on a cluster."""
    texts = [text(M.fit(learner(**DRAWN), rows.repartition(n), COLUMNS)) for n in (1, 3)]
    monkeypatch.setattr(boosting, "ROWS_IN_A_TASK", 0)
    texts += [text(M.fit(learner(**DRAWN), rows.repartition(n), COLUMNS)) for n in (1, 7)]
    monkeypatch.setattr(boosting, "SUMS_AT_ONCE", 2)
    texts.append(text(M.fit(learner(**DRAWN), rows.repartition(5), COLUMNS)))
    assert len(set(texts)) == 1 and texts[0].count("If") > 20


def test_jobs_do_not_grow_with_the_rounds(spark, rows):
    """A level was a job, so 120 rounds of 8 levels were about a thousand."""
    sc, jobs = spark.sparkContext, []
    for rounds in (2, 20):
        sc.setJobGroup(f"rounds-{rounds}", "")
        M.fit(learner(maxIter=rounds, maxDepth=2), rows, COLUMNS)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert abs(jobs[0] - jobs[1]) <= 2


def test_draws_follow_the_round_and_the_key():
    keys = np.arange(20_000, dtype=np.uint64)
    a, b = boosting.uniform(keys, 3), boosting.uniform(keys, 4)
    assert abs(np.mean(a < 0.8) - 0.8) < 0.02 and abs(np.corrcoef(a, b)[0, 1]) < 0.03
    assert (boosting.uniform(keys[:5], 3) == a[:5]).all()


def test_rows_without_an_id_and_what_is_left_behind(spark, rows, tmp_path):
    texts = [text(M.fit(learner(**DRAWN), rows.drop("complaint_id").repartition(n), COLUMNS)) for n in (1, 4)]
    assert texts[0] == texts[1]
    model = M.fit(learner(), rows, COLUMNS)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert text(again) == text(model) and again.stages[-1].getProbabilityCol() == "tree_probability"


@pytest.mark.parametrize("bad", ["cast(null AS int)", "2"])
def test_labels_that_are_none_are_errors(rows, bad):
    with pytest.raises(Exception, match="null|0 or 1"):
        M.fit(learner(), rows.withColumn(LABEL, F.expr(f"CASE WHEN complaint_id = 7 THEN {bad} ELSE {LABEL} END")), COLUMNS)


def test_a_label_without_positives_and_one_value(rows):
    found = M.fit(learner(), rows.withColumn(LABEL, F.lit(0)).withColumn("a", F.lit(1.0)), ["a", "b"])
    assert found.stages[-1].totalNumNodes == 6
    assert found.transform(rows.limit(3)).select(M.score_column()).first()[0] < 0.5


def test_a_search_fits_boosted_trees(rows):
    best, table = M.tune(learner(maxIter=3), {"maxDepth": [1, 3]}, rows, COLUMNS, folds=2)
    assert len(table.collect()) == 2 and best.transform(rows.limit(5)).count() == 5
