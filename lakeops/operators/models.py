"""Tree classifiers on ``pyspark.ml``: selection, fitting, calibration, evaluation, promotion.

Rows stay distributed from the feature table to the metrics. What reaches the driver is what
describes a model: importances of the input columns, two calibration coefficients, a threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from threading import Lock

from pyspark import SparkContext
from pyspark.ml import Model, PipelineModel
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.constants import (
    BOOSTED_GRID,
    BOOSTED_PARAMS,
    FOREST_GRID,
    FOREST_PARAMS,
    ID,
    LABEL,
    MODEL_INPUTS,
    RECALL_FLOOR,
    REPORT_COLUMNS,
    SEED,
    SELECTOR_PARAMS,
    SPLIT,
    TEST,
    TOP_FEATURES,
    TRAIN,
    TREE_GRID,
    TREE_PARAMS,
    TUNING_FOLDS,
    VALIDATION,
    WEIGHT,
)
from lakeops.operators import boosting, curves, growing
from lakeops.operators.features import stratified_halves
from lakeops.operators.scan import prefix_scan
from lakeops.sources.staging import fresh_path, stage, tidied

_OUTPUTS = {
    "featuresCol": "features",
    "labelCol": LABEL,
    "weightCol": WEIGHT,
    "seed": SEED,
    "probabilityCol": "tree_probability",
    "rawPredictionCol": "tree_raw",
    "predictionCol": "tree_prediction",
}

TREE, FOREST, BOOSTED = "decision_tree", "random_forest", "gradient_boosted"


class Boosted(GBTClassifier):
    """Boosted trees that are grown over blocks of binned rows (``boosting.py``), and don't depend on how rows are laid out."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        values = vector_to_array(self.getFeaturesCol())
        size = dataset.select(F.size(values)).first()
        if size is None:
            raise ValueError("no rows to fit")
        inputs = [f"input_{i}" for i in range(size[0])]
        kept = dict.fromkeys([self.getLabelCol(), *([self.getWeightCol()] if self.isSet("weightCol") else []), *([ID] if ID in dataset.columns else [])])
        with tidied(dataset.sparkSession):
            rows = stage(dataset.select(*[values[i].alias(c) for i, c in enumerate(inputs)], *kept), "boosted-rows")
            return self.fit_rows(rows, inputs, [ID] if ID in rows.columns else rows.columns)

    def fit_rows(self, rows: DataFrame, columns: Iterable[str], keys: Iterable[str]) -> GBTClassificationModel:
        """The model of rows that hold their inputs as columns."""
        edges = [e[1:-1] for e in bin_edges(rows, columns, self.getMaxBins())]
        return boosting.fit_boosted(self, rows, columns, keys, edges)


class Grown:
    """Trees of one set of rows for points of a grid that differ in the number or depth of trees alone: grown once, as far as any point needs."""

    def __init__(self, dataset: DataFrame, points: Iterable[tuple[int, int]]) -> None:
        self.dataset, self.points = dataset, sorted(set(points))
        self.trees, self.depth = (max(p[k] for p in self.points) for k in (0, 1))
        self.lock, self.found, self.scores = Lock(), None, None

    def nodes(self, estimator) -> tuple[list[growing.Nodes] | None, list | None]:
        with self.lock:
            if self.found is None:
                self.found = self.grown(estimator)
        return self.found

    def precision(self, estimator, held: DataFrame, point: tuple[int, int]) -> float:
        """Average precision of a point on the rows held out, which are scored once for all points."""
        nodes, edges = self.nodes(estimator)
        with self.lock:
            if self.scores is None:
                with tidied(held.sparkSession):
                    rows = stage(growing.scored(nodes, edges, self.points, held, vector_to_array(estimator.getFeaturesCol()), F.col(LABEL)), "points")
                    cumulative = curves.cumulative_scores(curves.score_table(rows, ("point",)), ("point",))
                    self.scores = {r["point"]: r["average_precision"] for r in curves.average_precision(cumulative, ("point",)).collect()}
        return float(self.scores[self.points.index(point)])

    def model(self, estimator, trees: int) -> RandomForestClassificationModel | None:
        """The estimator's model with so many trees; none where there are too many rows."""
        nodes, edges = self.nodes(estimator)
        if nodes is None:
            return None
        with tidied(self.dataset.sparkSession):
            return growing.model_of(estimator, [t.cut(estimator.getMaxDepth()) for t in nodes[:trees]], edges, self.dataset.sparkSession)

    def grown(self, estimator):
        spark = self.dataset.sparkSession
        draws = min(BAGS, self.trees) if estimator.hasParam("bootstrap") and estimator.getBootstrap() else 0
        if self.dataset.count() > growing.MOST_ROWS:
            return None, None
        size = self.dataset.select(F.size(vector_to_array(estimator.getFeaturesCol()))).first()[0]
        inputs = [f"input_{i}" for i in range(size)]
        values = vector_to_array(estimator.getFeaturesCol())
        kept = dict.fromkeys([LABEL, WEIGHT, *([ID] if ID in self.dataset.columns else [])])
        with tidied(spark):
            rows = stage(self.dataset.select(*[values[i].alias(c) for i, c in enumerate(inputs)], *kept), "grown-rows")
            keys = [ID] if ID in rows.columns else rows.columns
            edges = [e[1:-1] for e in bin_edges(rows, inputs, estimator.getMaxBins())]
            plan = growing.plan_of(estimator, size, max(len(e) for e in edges) + 1, self.trees, draws)
            plan = replace(plan, depth=self.depth)
            files = growing.blocks(plan, rows, [F.col(c) for c in inputs], F.col(LABEL), F.col(WEIGHT), [bag_count(k, keys) for k in range(draws)], edges, fresh_path(spark, "grown"))
            return growing.fit_trees(spark, plan, self.trees, files), edges


class Shared:
    """Fits of a grid: points that differ in the number or the depth of trees alone share their trees.

    Trees are drawn one by one, so the first of a larger forest are a forest of that size; and a tree cut at a depth is the tree grown to it.
    """

    _grown: Grown | None = None
    #: In a search, points are scored from the trees they share, and no models are made of them.
    _searching = False

    def trees(self) -> int:
        return self.getNumTrees() if self.hasParam("numTrees") else 1

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        points = [self.copy(m) for m in paramMaps]
        others = [tuple(sorted((p.name, v) for p, v in m.items() if p.name not in ("numTrees", "maxDepth"))) for m in paramMaps]
        alike = {o: [p for p, x in zip(points, others) if x == o] for o in others}
        grown = {o: Grown(dataset, [(p.trees(), p.getMaxDepth()) for p in some]) for o, some in alike.items()}
        keys = [(o, p.getMaxDepth()) for o, p in zip(others, points)]
        largest = {k: max((i for i, x in enumerate(keys) if x == k), key=lambda i: points[i].trees()) for k in keys}
        locks, fitted = {k: Lock() for k in largest}, {}

        def model(i: int):
            with locks[keys[i]]:
                if keys[i] not in fitted:
                    one = points[largest[keys[i]]].copy()
                    one._grown = grown[others[i]]
                    fitted[keys[i]] = one.fit(dataset)
            if self._searching:
                return SearchPoint(points[i], grown[others[i]])
            return first_trees(fitted[keys[i]], points[i].trees()) if self.hasParam("numTrees") else fitted[keys[i]]

        return _FitMultipleIterator(model, len(paramMaps))

    def _fit_java(self, dataset: DataFrame):
        if self._searching:
            return None
        if (self.getLabelCol(), self.getWeightCol() if self.isSet("weightCol") else None) != (LABEL, WEIGHT):
            return super()._fit_java(dataset)
        model = (self._grown or Grown(dataset, [(self.trees(), self.getMaxDepth())])).model(self, self.trees())
        if model is None:
            return super()._fit_java(dataset)
        # an object of its own: a wrapper that goes out of scope lets go of its object
        own = model if self.hasParam("numTrees") else model.trees[0]
        return own._java_obj.copy(own._empty_java_param_map())

    def _create_model(self, java_model):
        return super()._create_model(java_model) if java_model is not None else SearchPoint(self, self._grown)


class SearchPoint(Model):
    """A point of a grid in a search: all a search asks of it is how well it does on the rows held out."""

    def __init__(self, estimator: Shared, grown: Grown | None) -> None:
        super().__init__()
        self.estimator, self.grown = estimator, grown

    def _transform(self, dataset: DataFrame) -> DataFrame:
        e = self.estimator
        value = self.grown.precision(e, dataset, (e.trees(), e.getMaxDepth()))
        return dataset.sparkSession.createDataFrame([(value,)], "average_precision double")

    def transform(self, dataset: DataFrame, params=None) -> DataFrame:
        return self._transform(dataset)


class Tree(Shared, DecisionTreeClassifier):
    """A decision tree whose depths in a grid share their fits."""


class Forest(Shared, RandomForestClassifier):
    """A random forest whose numbers and depths of trees in a grid share their fits."""


def estimators() -> dict[str, object]:
    """The three learners with their fixed settings."""
    return {
        TREE: Tree(**_OUTPUTS, **TREE_PARAMS),
        FOREST: Forest(**_OUTPUTS, **FOREST_PARAMS),
        BOOSTED: Boosted(**{k: v for k, v in _OUTPUTS.items() if not k.startswith(("prob", "raw"))},
                               **BOOSTED_PARAMS)
        .setProbabilityCol("tree_probability")
        .setRawPredictionCol("tree_raw"),
    }


def grids() -> dict[str, Mapping[str, list]]:
    return {TREE: TREE_GRID, FOREST: FOREST_GRID, BOOSTED: BOOSTED_GRID}


def assembler(columns: Iterable[str] = MODEL_INPUTS) -> VectorAssembler:
    """Inputs to one vector; a null input is an error, not a dropped row."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def assemble(df: DataFrame, columns: Iterable[str] = MODEL_INPUTS) -> DataFrame:
    return assembler(columns).transform(df)


#: Least number of partitions of rows in a fixed layout, and rows of a partition beyond it.
FIT_PARTITIONS, FIT_ROWS = 16, 100_000
#: Bins of an input, draws of rows that the trees of a forest share out among them, and forests fitted at once.
BINS, BAGS, AT_ONCE = 32, 8, 4
#: Rows that all forests fitted at once hold in memory together.
ROWS_AT_ONCE = 20_000_000
#: Says that a label is 0 or 1, which a learner would else read all rows to find out.
BINARY = {"ml_attr": {"type": "binary"}}
#: Weights are multiples of one in so many, so that sums of them are exact whatever the order.
WEIGHT_STEPS = 1 << 12
BIN_SUFFIX = "_bin"
ID = "complaint_id"


def importance_table(spark: SparkSession, columns: Iterable[str], importances: Iterable[float]) -> DataFrame:
    """Inputs ranked by importance, ties in input order; one row per input column."""
    ranked = sorted(zip(columns, map(float, importances), strict=True), key=lambda p: -p[1])
    rows = [(rank, name, value) for rank, (name, value) in enumerate(ranked, start=1)]
    return spark.createDataFrame(
        rows, "selected_feature_rank int, feature_name string, importance_score double"
    )


def fit_partitions(rows: int) -> int:
    """Partitions for so many training rows: they grow with the rows, and depend on nothing else."""
    return max(FIT_PARTITIONS, -(-rows // FIT_ROWS))


def fixed_layout(train: DataFrame, columns: Iterable[str], partitions: int | None = None, more: Iterable[str] = ()) -> DataFrame:
    """Training rows in a layout that depends on the rows alone, for the learners that a search gives to the library.

    The library draws rows per partition, so a fit depends on how rows are laid out. Hashing by id (by
    all columns where there is none) into a number of partitions that follows from the number of rows, and sorting there, makes fits
    repeat on any machine and any input files. Give ``partitions`` to fix the number instead.
    """
    wanted = [*columns, LABEL, WEIGHT, *more]
    keys = [ID] if ID in train.columns else wanted
    kept = list(dict.fromkeys([*keys, *wanted]))
    rows = train.select(*kept).repartition(partitions or fit_partitions(train.count()), *keys)
    return rows.sortWithinPartitions(*kept).select(*wanted)


def bin_edges(train: DataFrame, columns: Iterable[str], bins: int = BINS) -> list[list[float]]:
    """Limits of the bins of each column: a bin per distinct value, or for more values bins of about equally many rows.

    Exact, and so the same for any layout of the rows; taken from the distinct values in order, of which no task holds more than a partition. At most ``bins`` rows a column come back.
    """
    columns = list(columns)
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    counts = train.select(F.inline(cells)).where("v IS NOT NULL").groupBy("c", "v").agg(F.count("*").alias("n"))
    ranked = prefix_scan(counts, [F.col("v")], {"upto": "n", "rank": F.lit(1)}, ["c"], {"total": "upto", "values": "rank"})
    place = F.when(F.col("values") <= bins, F.col("rank") - 1).otherwise(F.floor((F.col("upto") - F.col("n")) * bins / F.col("total")))
    found = ranked.groupBy("c", place.cast("int").alias("bin")).agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("c", "bin").collect()
    edges = []
    for i in range(len(columns)):
        held = [r for r in found if r["c"] == i]
        limits = [(a["high"] + b["low"]) / 2 for a, b in zip(held, held[1:])]
        edges.append([-math.inf, *(sorted(set(limits)) or [0.0]), math.inf])
    return edges


def binned(train: DataFrame, columns: Iterable[str]) -> list:
    """The stages that turn the columns into a vector of bin numbers, whose order counts: the sum drops the mark of a category."""
    columns = list(columns)
    names = [c + BIN_SUFFIX for c in columns]
    cut = Bucketizer(splitsArray=bin_edges(train, columns), inputCols=columns, outputCols=names, handleInvalid="error")
    places = ", ".join(f"`{n}` + 0.0D AS `{n}_place`" for n in names)
    return [cut, SQLTransformer(statement=f"SELECT *, {places} FROM __THIS__"), assembler([f"{n}_place" for n in names])]


def bag_count(bag: int, keys: Iterable[str]) -> Column:
    """How often a bootstrap draw holds a row: a Poisson number of mean 1, from a hash of the draw and the row's keys."""
    place = F.pmod(F.xxhash64(F.lit(SEED), F.lit(bag), *keys), F.lit(1 << 53)) / float(1 << 53)
    below, total = math.exp(-1.0), math.exp(-1.0)
    count = (place >= total).cast("int")
    for k in range(1, 9):
        below /= k
        total += below
        count = count + (place >= total).cast("int")
    return count


def learning_rows(train: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """Columns, label, rounded weight and keys of the training rows, written once for all fits; and the keys: the id, or all columns where there is none."""
    wanted = [*columns, LABEL, WEIGHT]
    keys = [ID] if ID in train.columns else wanted
    steps = F.round(F.col(WEIGHT) * WEIGHT_STEPS) / WEIGHT_STEPS
    return stage(train.select(*dict.fromkeys([*keys, *wanted])).withColumn(WEIGHT, steps), "learning-rows"), keys


def vectors(rows: DataFrame, stages: list, keys: Iterable[str]) -> DataFrame:
    """The vectors of bins with label, weight and keys, written once: a learner reads its rows several times before it holds them, for every draw."""
    ready = PipelineModel(stages).transform(rows).select("features", *dict.fromkeys([LABEL, WEIGHT, *keys]))
    return stage(ready, "vectors").withMetadata(LABEL, BINARY)


def fit_forest(estimator: RandomForestClassifier, rows: DataFrame, keys: Iterable[str], bags: int = BAGS) -> RandomForestClassificationModel:
    """A forest that doesn't depend on how rows are laid out; ``rows`` hold features, which are numbers of bins, label, weight and keys.

    The library's own bootstrap draws per partition. Here a row's draw is a hash of its keys. Trees take the draws in turn, and each is grown by one task (``growing.py``). Of more rows than
    that is made for, the library grows groups of trees, each of one draw given as a weight.
    """
    bags = min(bags, estimator.getNumTrees())
    return grown_model(estimator, rows, keys, bags) or library_forest(estimator, rows, keys, bags)


def grown_model(estimator, rows: DataFrame, keys: Iterable[str], bags: int) -> RandomForestClassificationModel | None:
    """The forest of rows whose features are numbers of bins, with so many draws (none: every tree gets all rows); none where there are too many rows."""
    spark, trees = rows.sparkSession, estimator.getNumTrees() if estimator.hasParam("numTrees") else 1
    if rows.count() > growing.MOST_ROWS:
        return None
    values = vector_to_array("features")
    size = rows.select(F.size(values)).first()[0]
    edges = [[k + 0.5 for k in range(BINS - 1)]] * size
    plan = growing.plan_of(estimator, size, BINS, trees, bags)
    with tidied(spark):
        files = growing.blocks(plan, rows, [values[i] for i in range(size)], F.col(LABEL), F.col(WEIGHT), [bag_count(k, keys) for k in range(bags)], edges, fresh_path(spark, "grown"))
        return growing.model_of(estimator, growing.fit_trees(spark, plan, trees, files), edges, spark)


def library_forest(estimator: RandomForestClassifier, rows: DataFrame, keys: Iterable[str], bags: int) -> RandomForestClassificationModel:
    """The same by the library. Groups of trees share a draw and grow together in one fit without a bootstrap, so there are as many fits as draws and not as trees; within a group,
    trees differ by the inputs that their nodes may split on. Several fits run at once as long as their rows fit in memory together; more rows keep all cores busy by themselves."""
    trees = estimator.getNumTrees()
    strategy = "sqrt" if estimator.getFeatureSubsetStrategy() == "auto" else estimator.getFeatureSubsetStrategy()
    library = RandomForestClassifier(**{p.name: v for p, v in estimator.extractParamMap().items() if p.name != "thresholds"})

    def grow(bag: int):
        number = trees // bags + (bag < trees % bags)
        drawn = rows.withColumn("_count", bag_count(bag, keys)).where("_count > 0").withColumn(WEIGHT, F.col(WEIGHT) * F.col("_count"))
        given = {library.numTrees: number, library.bootstrap: False, library.subsamplingRate: 1.0, library.seed: SEED + bag, library.featureSubsetStrategy: strategy}
        return library.fit(drawn.select("features", LABEL, WEIGHT), given)

    with ThreadPoolExecutor(max(1, min(AT_ONCE, ROWS_AT_ONCE // max(1, rows.count())))) as pool:
        parts = list(pool.map(grow, range(bags)))
    return joined_forest(parts)


def joined_forest(parts: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One model of the trees of several."""
    if len(parts) == 1:
        return parts[0]
    return forest_of(parts[0], [t for part in parts for t in part._java_obj.trees()])


def first_trees(model: RandomForestClassificationModel, number: int) -> RandomForestClassificationModel:
    """The forest of the first trees of a model."""
    return model if number == model.getNumTrees else forest_of(model, list(model._java_obj.trees())[:number])


def forest_of(first: RandomForestClassificationModel, trees: list) -> RandomForestClassificationModel:
    """A model of these trees, which is else like ``first``."""
    gateway = SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml.classification
    held = gateway.new_array(kinds.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        held[i] = tree
    java = kinds.RandomForestClassificationModel(first.uid, held, first.numFeatures, first.numClasses)
    java.set(java.getParam("numTrees"), len(trees))
    model = RandomForestClassificationModel(java)
    for name in ("featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
        model._set(**{name: first.getOrDefault(name)})
    return model


def select_features(train: DataFrame, columns: Iterable[str] = MODEL_INPUTS) -> DataFrame:
    """Importance table of a selector forest over all candidate inputs."""
    columns = list(columns)
    model = fit(RandomForestClassifier(**_OUTPUTS, **SELECTOR_PARAMS), train, columns).stages[-1]
    return importance_table(train.sparkSession, columns, model.featureImportances.toArray())


def top_features(importances: DataFrame, k: int = TOP_FEATURES) -> list[str]:
    ranked = importances.orderBy("selected_feature_rank").limit(k)
    return [r["feature_name"] for r in ranked.select("feature_name").collect()]


def fit(estimator, train: DataFrame, columns: Iterable[str]) -> PipelineModel:
    """Assemble and fit one learner on weighted training rows.

    All get exact bins, weights whose sums are exact and hashed draws, so that equal rows give equal models in any number of partitions.
    """
    columns = list(columns)
    rows, keys = learning_rows(train, columns)
    if isinstance(estimator, Boosted):
        return PipelineModel([assembler(columns), estimator.fit_rows(rows, columns, keys)])
    stages = binned(rows, columns)
    ready = vectors(rows, stages, keys)
    if isinstance(estimator, RandomForestClassifier):
        return PipelineModel([*stages, fit_forest(estimator, ready, keys)])
    grown = grown_model(estimator, ready, keys, 0) if isinstance(estimator, Tree) else None
    return PipelineModel([*stages, grown.trees[0] if grown else estimator.fit(ready.select("features", LABEL, WEIGHT))])


def score_column(probability: str = "tree_probability"):
    """Positive-class probability out of a probability vector."""
    return vector_to_array(F.col(probability))[1]


# ---- calibration ---------------------------------------------------------------------------------


def platt_rows(scored: DataFrame, score: str, label: str = LABEL) -> DataFrame:
    """Weighted rows whose logistic fit is the sigmoid with Platt's softened targets.

    A row with target t counts t times as a positive and 1-t times as a negative. Rows are
    combined per distinct score and label, and written, first: the scores come out of a model
    that must not run again in every pass over them.
    """
    grouped = scored.groupBy(F.col(score).alias("score"), F.col(label).alias("y"))
    counts = stage(grouped.agg(F.count("*").cast("double").alias("n")), "calibration-scores")
    positives = F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("n"))), F.lit(0.0))
    negatives = F.coalesce(F.sum(F.when(F.col("y") == 0, F.col("n"))), F.lit(0.0))
    targets = counts.agg(
        F.struct(
            ((positives + 1) / (positives + 2)).alias("high"), (1 / (negatives + 2)).alias("low")
        ).alias("targets")
    ).scalar()
    target = F.when(F.col("y") == 1, targets["high"]).otherwise(targets["low"])
    both = F.array(
        F.struct(F.lit(1.0).alias("platt_label"), (F.col("n") * target).alias("platt_weight")),
        F.struct(F.lit(0.0).alias("platt_label"), (F.col("n") * (1 - target)).alias("platt_weight")),
    )
    return counts.select("score", F.inline(both))


def platt_calibrate(scored: DataFrame, score: str = "score", label: str = LABEL, output: str = "tree_score"):
    """Fitted sigmoid over one score; its input is the vector column ``output``."""
    rows = VectorAssembler(inputCols=["score"], outputCol=output).transform(platt_rows(scored, score, label))
    regression = LogisticRegression(
        featuresCol=output,
        labelCol="platt_label",
        weightCol="platt_weight",
        regParam=0.0,
        maxIter=200,
        tol=1e-10,
        probabilityCol="probability",
        rawPredictionCol="platt_raw",
        predictionCol="platt_prediction",
    )
    return regression.fit(rows)


def calibrated(model: PipelineModel, calibration: DataFrame) -> PipelineModel:
    """The frozen model followed by a sigmoid fitted on unweighted calibration rows."""
    scored = model.transform(calibration).select(score_column().alias("score"), LABEL)
    sigmoid = platt_calibrate(scored)
    positive = VectorSlicer(inputCol="tree_probability", outputCol="tree_score", indices=[1])
    return PipelineModel(stages=[*model.stages, positive, sigmoid])


def predict(model, df: DataFrame, name: str = "probability") -> DataFrame:
    """Add the positive-class probability of a calibrated model (or of any ``DataFrame`` function)."""
    if callable(model) and not hasattr(model, "transform"):
        return model(df)
    kept = [c for c in df.columns if c != name]
    return model.transform(df).select(*kept, score_column("probability").alias(name))


# ---- tuning --------------------------------------------------------------------------------------


class AveragePrecision(Evaluator):
    """Step-wise average precision of ``tree_probability`` as a tuning metric."""

    def _evaluate(self, dataset: DataFrame) -> float:
        if dataset.columns == ["average_precision"]:  # found for all points at once
            return float(dataset.first()[0])
        rows = dataset.select(score_column().alias("probability"), F.col(LABEL).alias("label"))
        cumulative = curves.cumulative_scores(curves.score_table(rows, groups=()), groups=())
        return float(curves.average_precision(cumulative, groups=()).first()[0])

    def isLargerBetter(self) -> bool:
        return True


FOLD = "tuning_fold"


def with_folds(train: DataFrame, columns: Iterable[str], folds: int) -> DataFrame:
    """What a search needs of the training rows, with the fold of each: whatever the partitions, a row's fold is the same."""
    keys = [ID] if ID in train.columns else [*columns, LABEL, WEIGHT]
    fold = F.pmod(F.xxhash64(F.lit("tuning"), *keys), F.lit(folds)).cast("int")
    return train.select(*dict.fromkeys([*keys, *columns, LABEL, WEIGHT]), fold.alias(FOLD))


def tune(estimator, grid: Mapping[str, list], train: DataFrame, columns: Iterable[str],
         folds: int = TUNING_FOLDS, parallelism: int = 4):
    """Grid search by cross-validated average precision; ``(best model, results per grid point)``.

    A row's fold is a hash of its id (of all columns where there is none). Folds are dealt once and written, so that neither they nor the plan before them are computed again
    for a fold or a point of the grid; a fold's rows are laid out once for all its fits. Points that differ in the number or depth of trees share their trees, and are scored together.
    """
    columns = list(columns)
    points = ParamGridBuilder()
    for name, values in grid.items():
        points = points.addGrid(getattr(estimator, name), values)
    points = points.build()
    dealt = stage(with_folds(train, columns, folds), "folds")
    searched = estimator.copy()
    searched._searching = isinstance(estimator, Shared) and dealt.count() <= growing.MOST_ROWS
    search = CrossValidator(
        estimator=searched,
        estimatorParamMaps=points,
        evaluator=AveragePrecision(),
        numFolds=folds,
        foldCol=FOLD,
        seed=SEED,
        parallelism=parallelism,
    )
    fitted = search.fit(assemble(fixed_layout(dealt, columns, more=[FOLD, *([ID] if ID in dealt.columns else [])]), columns).select("features", LABEL, WEIGHT, FOLD, *([ID] if ID in dealt.columns else [])))
    table = train.sparkSession.createDataFrame(
        [
            ({p.name: float(v) for p, v in point.items()}, float(score))
            for point, score in zip(points, fitted.avgMetrics, strict=True)
        ],
        "params map<string, double>, average_precision double",
    )
    if isinstance(estimator, GBTClassifier):
        return PipelineModel(stages=[assembler(columns), fitted.bestModel]), table
    best = max(range(len(points)), key=lambda i: fitted.avgMetrics[i])
    return fit(estimator.copy(points[best]), train, columns), table


# ---- evaluation ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoredModel:
    name: str
    base: PipelineModel
    model: PipelineModel


def fit_and_calibrate(name: str, estimator, encoded: DataFrame, columns: Iterable[str]) -> ScoredModel:
    """Fit on TRAIN and calibrate on the first half of VALIDATION."""
    base = fit(estimator, encoded.filter(F.col(SPLIT) == TRAIN), columns)
    first = validation_half(encoded, 1)
    return ScoredModel(name, base, calibrated(base, first))


def validation_half(encoded: DataFrame, half: int) -> DataFrame:
    halves = stratified_halves(encoded.filter(F.col(SPLIT) == VALIDATION), method="xxhash64")
    return halves.filter(F.col("half") == half)


def score_models(models: Iterable[ScoredModel], encoded: DataFrame) -> DataFrame:
    """Held-out rows of every model with their probability, written once.

    Columns: model_name, the report columns, label, split, ``half`` (of VALIDATION; the
    second half is the one thresholds are chosen on), the calibrated ``probability`` and the learner's own ``raw_probability``.
    """
    held_out = stratified_halves(encoded.filter(F.col(SPLIT) != TRAIN), method="xxhash64")
    parts = [
        m.model.transform(held_out).select(
            F.lit(m.name).alias("model_name"), *REPORT_COLUMNS, LABEL, SPLIT, "half",
            score_column("probability").alias("probability"), score_column().alias("raw_probability"),
        )
        for m in models
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return stage(union, "scored-models")


def calibration_reliability(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Reliability bins per model of its raw and its calibrated probabilities (``kind``): what calibration changed."""
    both = scored.select(
        "model_name",
        F.col(LABEL).alias("label"),
        F.inline(
            F.array(
                F.struct(F.lit("raw").alias("kind"), F.col("raw_probability").alias("probability")),
                F.struct(F.lit("calibrated").alias("kind"), F.col("probability").alias("probability")),
            )
        ),
    )
    groups = ("model_name", "kind")
    return curves.reliability_bins(curves.cumulative_scores(curves.score_table(both, groups), groups), bins, groups)


def choose_thresholds(scored: DataFrame, floor: float = RECALL_FLOOR) -> DataFrame:
    """Per model, the recall-floor threshold on the second half of VALIDATION."""
    rows = scored.filter((F.col(SPLIT) == VALIDATION) & (F.col("half") == 2))
    groups = ("model_name",)
    cumulative = curves.cumulative_scores(curves.score_table(rows, groups, label=LABEL), groups)
    return stage(curves.threshold_for_recall(curves.pr_curve(cumulative, groups), groups, floor), "thresholds")


def metrics_table(scored: DataFrame, thresholds: DataFrame, selected: Iterable[str]) -> DataFrame:
    """Metrics of every model on VALIDATION and TEST."""
    cumulative = curves.cumulative_scores(curves.score_table(scored, label=LABEL))
    metrics = curves.binary_metrics(cumulative, thresholds, selected)
    return metrics.withColumn("_model_run_at", F.current_timestamp())


def predictions_table(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """TEST rows of every model with label, probability and decision."""
    rows = scored.filter(F.col(SPLIT) == TEST).join(thresholds, "model_name")
    report = [c for c in REPORT_COLUMNS if c != ID]
    return rows.select(
        "model_name",
        ID,
        LABEL,
        (F.col("probability") >= F.col("threshold")).cast("int").alias("prediction"),
        F.col("probability").alias("predicted_probability_untimely"),
        SPLIT,
        *report,
        F.current_timestamp().alias("_model_run_at"),
    )


def model_importances(models: Iterable[ScoredModel], columns: Iterable[str]) -> DataFrame:
    """Importance of every selected input in every model."""
    columns = list(columns)
    models = list(models)
    spark = SparkSession.getActiveSession()
    rows = [
        (m.name, c, float(v))
        for m in models
        for c, v in zip(columns, m.base.stages[-1].featureImportances.toArray(), strict=True)
    ]
    return spark.createDataFrame(rows, "model_name string, feature_name string, importance_score double")
