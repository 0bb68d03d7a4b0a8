"""Classification trees and forests grown over blocks of binned rows, each tree by one task.

The library's trees (Gini impurity, weighted rows, a share of the inputs per node, leaves of one prediction joined), grown otherwise. Rows are written once as blocks in the shared folder, as for the
boosted learner. A task grows two trees at a time, level by level, and reads the blocks once for each level, so that it holds a block, and of each row the number of its node. There is no
exchange between tasks and no job per level. Inputs that a node may split on are drawn for the tree, the level and the node, and rows by a hash of their keys; so equal rows give
equal trees in any layout, the first trees of a forest are a smaller forest, and a tree cut at a depth is the tree grown to it.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.boosting import BLOCK_ROWS, WEIGHT_STEPS, bin_type, inputs_per_node, load, save
from lakeops.sources.staging import fresh_path

#: Trees that a task grows side by side, and the most rows that trees are grown of in this way: a task holds four bytes a row for each of these trees.
TREES_AT_ONCE, MOST_ROWS = 2, 40_000_000
_LISTED = "path string, rows long"


@dataclass(frozen=True)
class Plan:
    """What a fit is told: the settings of the learner, the bins of an input and the draws of rows that trees take in turn (none: all rows)."""

    depth: int
    inputs: int
    least_rows: int
    least_weight: float
    least_gain: float
    seed: int
    bins: int
    columns: int
    draws: int


@dataclass(frozen=True)
class Nodes:
    """The nodes of a tree, level by level; a node's right child follows its left one, and a leaf has none (-1)."""

    level: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    counts: np.ndarray

    def cut(self, depth: int) -> Nodes:
        """The tree grown to this depth."""
        kept = self.level <= depth
        inner = kept & (self.level < depth)
        found = replace(self, left=np.where(inner, self.left, -1), gain=np.where(inner, self.gain, -1.0))
        return Nodes(*(getattr(found, n)[kept] for n in Nodes.__dataclass_fields__))

    def prediction(self) -> np.ndarray:
        return (self.counts[:, 1] > self.counts[:, 0]).astype(np.int64)

    def joined(self) -> Nodes:
        """Siblings that are leaves of one prediction become one leaf, as the library has it; what is below it stays in the arrays, unreached."""
        left, gain, said = self.left.copy(), self.gain.copy(), self.prediction()
        for level in range(int(self.level.max()) - 1, -1, -1):
            node = np.flatnonzero((self.level == level) & (left >= 0))
            a = left[node]
            same = (left[a] < 0) & (left[a + 1] < 0) & (said[a] == said[a + 1])
            left[node[same]], gain[node[same]] = -1, -1.0
        return replace(self, left=left, gain=gain)

    def numbered(self) -> np.ndarray:
        """A node's number in a depth-first walk, -1 for nodes that the root doesn't reach."""
        size = np.ones(len(self.left), np.int64)
        inner = [np.flatnonzero((self.level == k) & (self.left >= 0)) for k in range(int(self.level.max()) + 1)]
        for node in reversed(inner):
            size[node] += size[self.left[node]] + size[self.left[node] + 1]
        found = np.full(len(size), -1, np.int64)
        found[0] = 0
        for node in inner:
            node = node[found[node] >= 0]
            a = self.left[node]
            found[a] = found[node] + 1
            found[a + 1] = found[a] + size[a]
        return found


# ---- blocks --------------------------------------------------------------------------------------


def packed(plan: Plan, edges: list[np.ndarray], folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (inputs, label, weight, how often each draw holds it) to files of blocks; no two attempts write the same file, and the listing says which count."""
    schema = pa.schema([("path", pa.string()), ("rows", pa.int64())])

    def block(rows: pa.Table) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in rows.columns]
        if any(c.null_count for c in rows.columns) or any(np.isnan(c).any() for c in columns):
            raise ValueError("inputs, labels and weights must not be null")
        inputs, label, weight, counts = columns[: plan.columns], columns[plan.columns], columns[plan.columns + 1], columns[plan.columns + 2 :]
        if not np.isin(label, (0.0, 1.0)).all() or (weight < 0).any():
            raise ValueError("labels must be 0 or 1, weights 0 or more")
        bins = np.stack([np.searchsorted(e, v, "left") for e, v in zip(edges, inputs)]).astype(bin_type(plan.bins))
        path = f"{folder}/b{uuid.uuid4().hex}"
        drawn = np.stack(counts).astype(np.uint8) if counts else np.empty((0, len(label)), np.uint8)
        save(path, (bins, np.rint(weight * WEIGHT_STEPS), label.astype(np.int8), drawn))
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([rows.num_rows])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            while rows >= BLOCK_ROWS:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK_ROWS))
                held, rows = table.slice(BLOCK_ROWS).to_batches(), rows - BLOCK_ROWS
        if rows:
            yield block(pa.Table.from_batches(held))

    return run


# ---- growing -------------------------------------------------------------------------------------


class Growing:
    """A tree while it grows: the last level's splits, and of each row of each block its place in the level, -1 if it isn't drawn or its node is a leaf."""

    def __init__(self, plan: Plan, number: int) -> None:
        self.plan, self.number, self.level = plan, number, 0
        self.places: list[np.ndarray] = []
        self.held: list[tuple[np.ndarray, ...]] = []
        self.open(1)

    def open(self, nodes: int) -> None:
        """Draw the inputs of the next level's nodes and begin their sums."""
        plan, self.nodes = self.plan, nodes
        if plan.inputs < plan.columns:
            order = np.random.default_rng([plan.seed, self.number, self.level]).random((nodes, plan.columns)).argsort(1)
            self.inputs = np.sort(order[:, : plan.inputs], 1)
        else:
            self.inputs = np.broadcast_to(np.arange(plan.columns), (nodes, plan.columns))
        self.weights = np.zeros(nodes * plan.inputs * plan.bins * 2)
        self.rows = np.zeros(nodes * plan.inputs * plan.bins)

    def read(self, k: int, bins: np.ndarray, weight: np.ndarray, label: np.ndarray, drawn: np.ndarray) -> None:
        """Move a block's rows down one level and add them up."""
        plan, rows = self.plan, len(label)
        count = drawn[self.number % plan.draws] if plan.draws else None
        flat = bins.reshape(-1)
        if self.level == 0:
            held = weight > 0 if count is None else (weight > 0) & (count > 0)
            self.places.append(np.where(held, 0, -1).astype(np.int32))
            at = np.flatnonzero(held)
            place = np.zeros(len(at), np.int64)
        else:
            feature, cut, child = self.down
            at = np.flatnonzero(self.places[k] >= 0)
            place = self.places[k].take(at).astype(np.int64)
            place = child.take(place) + (flat.take(feature.take(place) * rows + at) > cut.take(place))
            self.places[k][at] = place
            at, place = at[place >= 0], place[place >= 0]
        w = weight.take(at) if count is None else weight.take(at) * count.take(at)
        y = label.take(at)
        inputs = np.ascontiguousarray(self.inputs)
        for i in range(plan.inputs):
            code = (place * plan.inputs + i) * plan.bins + flat.take(inputs[:, i].take(place) * rows + at)
            if plan.least_rows > 1:
                self.rows += np.bincount(code, minlength=len(self.rows))
            self.weights += np.bincount(code * 2 + y, w, len(self.weights))

    def split(self) -> bool:
        """Split the nodes of the level; whether there are nodes to follow."""
        plan, shape = self.plan, (self.nodes, self.plan.inputs, self.plan.bins)
        weights = self.weights.reshape(*shape, 2) / WEIGHT_STEPS
        whole = weights[:, 0].sum(1)
        if self.level == 0:
            self.least = plan.least_weight * whole.sum()
        at = np.arange(self.nodes)
        none = np.full(self.nodes, -1, np.int64)
        if self.level == plan.depth or plan.bins < 2:
            self.held.append((none, none, none, np.full(self.nodes, -1.0), whole))
            return False
        left = np.cumsum(weights, 2)[:, :, :-1]
        right = whole[:, None, None] - left
        total, a, b = whole.sum(1), left.sum(3), right.sum(3)
        valid = (a > 0) & (b > 0) & (a >= self.least) & (b >= self.least)
        if plan.least_rows > 1:
            rows = self.rows.reshape(shape)
            below = np.cumsum(rows, 2)[:, :, :-1]
            valid &= (below >= plan.least_rows) & (rows[:, 0].sum(1)[:, None, None] - below >= plan.least_rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            gini = lambda c, n: 1.0 - (c[..., 0] / n) ** 2 - (c[..., 1] / n) ** 2
            own = gini(whole, total)[:, None, None]
            gain = own - a / total[:, None, None] * gini(left, a) - b / total[:, None, None] * gini(right, b)
        flat = np.where(valid & (gain > 0) & (gain >= plan.least_gain), gain, -1.0).reshape(self.nodes, -1)
        best = flat.argmax(1)
        i, cut = np.divmod(best, plan.bins - 1)
        gain, feature = flat[at, best], self.inputs[at, i]
        inner = gain > 0
        child = np.where(inner, 2 * (np.cumsum(inner) - 1), -1)
        self.held.append((np.where(inner, feature, -1), np.where(inner, cut, -1), child, np.where(inner, gain, -1.0), whole))
        self.down = (feature, np.where(inner, cut, plan.bins), child)
        self.level += 1
        if inner.any():
            self.open(2 * int(inner.sum()))
        return bool(inner.any())

    def tree(self) -> Nodes:
        sizes = [len(h[0]) for h in self.held]
        starts = np.cumsum([0, *sizes])
        left = [np.where(h[2] >= 0, h[2] + starts[k + 1], -1) for k, h in enumerate(self.held)]
        join = lambda j: np.concatenate([h[j] for h in self.held])
        return Nodes(np.repeat(np.arange(len(sizes)), sizes), join(0), join(1), np.concatenate(left), join(3), join(4))


def grow(plan: Plan, files: list[tuple[str, int]], numbers: Iterable[int]) -> list[tuple[int, Nodes]]:
    """The trees of these numbers, side by side: a level of all takes one pass over the blocks."""
    growing = [Growing(plan, n) for n in numbers]
    left = list(growing)
    while left:
        for k, (path, rows) in enumerate(files):
            arrays = load(path, [(bin_type(plan.bins), (plan.columns, rows)), (np.float64, (rows,)), (np.int8, (rows,)), (np.uint8, (plan.draws, rows))])
            for tree in left:
                tree.read(k, *arrays)
        left = [tree for tree in left if tree.split()]
    return [(tree.number, tree.tree()) for tree in growing]


def fit_trees(spark, plan: Plan, trees: int, files: list[tuple[str, int]]) -> list[Nodes]:
    numbers = [list(range(trees))[i : i + TREES_AT_ONCE] for i in range(0, trees, TREES_AT_ONCE)]
    found = spark.sparkContext.parallelize(numbers, len(numbers)).flatMap(lambda some: grow(plan, files, some)).collect()
    return [tree for _, tree in sorted(found, key=lambda t: t[0])]


def plan_of(estimator, columns: int, bins: int, trees: int, draws: int) -> Plan:
    forest = isinstance(estimator, RandomForestClassifier)
    strategy = estimator.getFeatureSubsetStrategy() if forest else "all"
    strategy = "sqrt" if strategy == "auto" and trees > 1 else strategy
    return Plan(
        depth=estimator.getMaxDepth(), inputs=inputs_per_node(strategy, columns), least_rows=estimator.getMinInstancesPerNode(), least_weight=estimator.getMinWeightFractionPerNode(),
        least_gain=estimator.getMinInfoGain(), seed=abs(estimator.getSeed()), bins=bins, columns=columns, draws=draws,
    )


def blocks(plan: Plan, rows: DataFrame, inputs: Iterable[Column], label: Column, weight: Column, counts: Iterable[Column], edges: Iterable[Iterable[float]], folder: str) -> list[tuple[str, int]]:
    """Write the rows as blocks; their files in the order of their size."""
    columns = [*inputs, label, weight, *counts]
    wanted = rows.select(*[c.cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    listed = wanted.mapInArrow(packed(plan, [np.array(list(e), np.float64) for e in edges], folder), _LISTED).collect()
    if not listed:
        raise ValueError("no rows to fit")
    return sorted((r["path"], r["rows"]) for r in listed)


# ---- the model -----------------------------------------------------------------------------------

_MODELS = "org.apache.spark.ml.classification."


def model_of(estimator, trees: list[Nodes], edges: Iterable[Iterable[float]], spark) -> RandomForestClassificationModel:
    """The trees as a forest of the library: written as it writes one, and read by it."""
    path, edges = fresh_path(spark, "forest-model"), [np.array(list(e), np.float64) for e in edges]

    def described(kind: str, uid: str, params: dict, **more) -> str:
        return json.dumps({"class": _MODELS + kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": {}} | more)

    own = {p.name: v for p, v in estimator.extractParamMap().items() if p.name != "thresholds"}
    known = {n: v for n, v in own.items() if n in _TREE_PARAMS}
    whole = described("RandomForestClassificationModel", estimator.uid, known | {n: own[n] for n in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap") if n in own} | {"numTrees": len(trees)},
                      numFeatures=len(edges), numClasses=2, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    heads = [(i, described("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", known, numFeatures=len(edges), numClasses=2), 1.0) for i in range(len(trees))]
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    limits = np.full((len(edges), max(1, max(len(e) for e in edges))), math.nan)
    for f, e in enumerate(edges):
        limits[f, : len(e)] = e
    spark.createDataFrame(pa.Table.from_batches([nodes_of(i, tree.joined(), limits) for i, tree in enumerate(trees)])).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


_TREE_PARAMS = ("featuresCol", "labelCol", "weightCol", "predictionCol", "probabilityCol", "rawPredictionCol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "minWeightFractionPerNode", "seed", "impurity")


def nodes_of(number: int, tree: Nodes, limits: np.ndarray) -> pa.RecordBatch:
    """A tree as the rows the library keeps."""
    place = tree.numbered()
    at = np.flatnonzero(place >= 0)
    inner, left = tree.left[at] >= 0, tree.left[at]
    counts, total = tree.counts[at], tree.counts[at].sum(1)
    share = np.divide(counts, total[:, None], out=np.zeros_like(counts), where=total[:, None] > 0)
    children = [np.where(inner, place[np.where(inner, left + k, 0)], -1) for k in (0, 1)]
    feature = np.where(inner, tree.feature[at], -1)
    cuts = limits[feature[inner], tree.bin[at][inner]]
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values, pa.float64()))
    split = pa.StructArray.from_arrays(
        [pa.array(feature, pa.int32()), lists(np.cumsum(inner), cuts), pa.array(np.full(len(at), -1), pa.int32())], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    columns = {
        "id": pa.array(place[at], pa.int32()), "prediction": pa.array(tree.prediction()[at].astype(np.float64)),
        "impurity": pa.array(1.0 - (share**2).sum(1)), "impurityStats": lists(np.arange(1, len(at) + 1) * 2, counts.reshape(-1)),
        "rawCount": pa.array(np.full(len(at), -1), pa.int64()), "gain": pa.array(tree.gain[at]),
        "leftChild": pa.array(children[0], pa.int32()), "rightChild": pa.array(children[1], pa.int32()), "split": split,
    }
    data = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number), pa.int32()), data], ["treeID", "nodeData"])


# ---- scoring the points of a grid ----------------------------------------------------------------


def chances(tree: Nodes, depth: int) -> np.ndarray:
    """Per node of a tree the share of positives in the leaf that its rows come to in the tree cut at this depth."""
    shown = replace(tree, left=np.where(tree.level < depth, tree.left, -1)).joined()
    total = tree.counts.sum(1)
    found = np.divide(tree.counts[:, 1], total, out=np.zeros(len(total)), where=total > 0)
    closed = shown.left < 0
    for level in range(int(tree.level.max())):
        node = np.flatnonzero((tree.level == level) & (tree.left >= 0))
        for child in (tree.left[node], tree.left[node] + 1):
            found[child] = np.where(closed[node], found[node], found[child])
            closed[child] |= closed[node]
    return found


def scored(trees: list[Nodes], edges: Iterable[Iterable[float]], points: list[tuple[int, int]], rows: DataFrame, features: Column, label: Column) -> DataFrame:
    """Rows of (point, probability, label): what the first so many trees, cut at a depth, say of each row, for every such point; a tree is walked once for all of them."""
    edges = [np.array(list(e), np.float64) for e in edges]
    depths = sorted({d for _, d in points})
    small = [(t.feature.astype(np.int32), t.bin.astype(np.int32), np.where(t.left >= 0, t.left, np.arange(len(t.left))).astype(np.int32), [chances(t, d) for d in depths]) for t in trees]
    held, levels = rows.sparkSession.sparkContext.broadcast(small), max(depths)
    names = [f"p{i}" for i in range(len(points))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(edges))
            bins = np.stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(edges)])
            flat, row, found = bins.reshape(-1), np.arange(len(batch)), {}
            sums = np.zeros((len(depths), len(batch)))
            for number, (feature, cut, left, said) in enumerate(held.value, 1):
                node = np.zeros(len(batch), np.int64)
                for _ in range(levels):
                    below = left.take(node)
                    node = np.where(below == node, node, below + (flat.take(feature.take(node).clip(0) * len(batch) + row) > cut.take(node)))
                for i, s in enumerate(said):
                    sums[i] += s.take(node)
                for i, (trees_, depth) in enumerate(points):
                    if trees_ == number:
                        found[i] = sums[depths.index(depth)] / number
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(found[i]) for i in range(len(points))]], ["label", *names])

    wide = rows.select(features, label.cast("int")).mapInArrow(run, "label int, " + ", ".join(f"{n} double" for n in names))
    return wide.select("label", F.inline(F.array(*[F.struct(F.lit(i).alias("point"), F.col(n).alias("probability")) for i, n in enumerate(names)])))
