"""Gradient-boosted trees over blocks of binned rows.

The same learner as ``GBTClassifier`` (logistic loss on labels of -1 and 1, trees of means fitted to its negative gradient by variance, a share of the rows per tree, a
share of the inputs per node), grown otherwise:

1. Rows become blocks in the shared folder: a byte per input for its bin, the label, the weight and a hash of the row's keys. A round adds a file per block with the margins
   and gradients of its rows. Files of rounds gone by are removed; nothing is cached, and no plan grows with the rounds.
2. A level of a tree is one job without a shuffle: each task adds up the blocks it was dealt and returns sums per node, input and bin. Of two siblings only the lighter one is
   added up; the other is what is left of their parent.
3. Rows that one task can hold (``ROWS_IN_A_TASK``) need no jobs between the levels: one task grows all trees by the same code.

Weights and gradients are rounded to fixed steps, so that all sums are exact, and draws are hashes of the keys. So equal rows give equal models, however they are laid out and however often.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.sources.archives import _open
from lakeops.sources.staging import fresh_path, tidied

#: Rows of a block, of which a task holds one at a time; and rows that one task may hold together, to grow all trees by itself.
BLOCK_ROWS, ROWS_IN_A_TASK = 1 << 17, 2_000_000
#: Cells that inputs added up together may have, and rows whose node is looked up together: both stay in a core's cache.
CELLS, CHUNK = 1024, 1 << 14
#: Tasks whose sums go to the driver as they are; those of more are added up on the way.
SUMS_AT_ONCE = 32
#: Weights are multiples of one in so many. Gradients have up to 20 bits behind the point, as many as keep sums exact, and at least 8.
WEIGHT_STEPS, MOST_BITS, LEAST_BITS, EXACT_BITS = 1 << 12, 20, 8, 52
_UNDRAWN = np.iinfo(np.int32).min
_BLOCK = "path string, rows long"


@dataclass(frozen=True)
class Plan:
    """What a fit is told: the settings of the learner, the edges of the bins and the steps of gradients."""

    rounds: int
    depth: int
    step: float
    rate: float
    inputs: int
    least_rows: int
    least_weight: float
    least_gain: float
    seed: int
    edges: list[np.ndarray]
    steps: int

    @property
    def bins(self) -> int:
        return max(len(e) for e in self.edges) + 1

    def groups(self) -> list[list[int]]:
        """Inputs added up together: those whose bins make up to ``CELLS`` cells."""
        found: list[list[int]] = []
        for f in sorted(range(len(self.edges)), key=lambda f: -len(self.edges[f])):
            size = lambda g: math.prod(len(self.edges[i]) + 1 for i in g)
            place = next((g for g in found if size([*g, f]) <= CELLS), None)
            if place is None:
                found.append([f])
            else:
                place.append(f)
        return found

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """Per group and row the cell of its bins."""
        found = []
        for group in self.groups():
            code = bins[group[0]].astype(np.int32)
            for f in group[1:]:
                code = code * (len(self.edges[f]) + 1) + bins[f]
            found.append(code)
        return np.stack(found).astype(bin_type(max(CELLS, self.bins)))


@dataclass
class Tree:
    """Nodes in the order they were made; a node's right child follows its left one, and a leaf is its own left child."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    total: list[float] = field(default_factory=list)

    def add(self, weight: float, total: float) -> int:
        node = len(self.left)
        for values, value in ((self.feature, 0), (self.bin, 1 << 30), (self.left, node), (self.gain, -1.0), (self.weight, weight), (self.total, total)):
            values.append(value)
        return node

    def values(self) -> np.ndarray:
        weight = np.array(self.weight)
        return np.divide(self.total, weight, out=np.zeros(len(weight)), where=weight > 0)

    def down(self, bins: np.ndarray, nodes: np.ndarray, levels: int) -> None:
        """Move each row's node down by so many levels; ``bins`` are by input and row."""
        rows = bins.shape[1]
        feature, cut, left = (np.array(x, np.int64) for x in (self.feature, self.bin, self.left))
        feature, flat = feature * rows, bins.reshape(-1)
        for at in range(0, rows if levels > 0 else 0, CHUNK):
            node = nodes[at : at + CHUNK]
            row = np.arange(at, at + len(node))
            for _ in range(levels):
                node[:] = left.take(node) + (flat.take(row + feature.take(node)) > cut.take(node))


# ---- blocks --------------------------------------------------------------------------------------


def save(path: str, arrays: Iterable[np.ndarray]) -> None:
    with _open(path, "w") as sink:
        for a in arrays:
            sink.write(np.ascontiguousarray(a).data)


def load(path: str, kinds: Iterable[tuple[object, tuple[int, ...]]]) -> list[np.ndarray]:
    """The first arrays of a file."""
    kinds = list(kinds)
    sizes = [np.dtype(kind).itemsize * math.prod(shape) for kind, shape in kinds]
    with _open(path, "r") as source:
        data = source.read(sum(sizes))
    ends = np.cumsum([0, *sizes])
    return [np.frombuffer(data, kind, math.prod(shape), int(at)).reshape(shape) for (kind, shape), at in zip(kinds, ends)]


def bin_type(bins: int) -> type:
    return np.uint8 if bins <= 1 << 8 else np.uint16 if bins <= 1 << 16 else np.int32


def packed(plan: Plan, folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (inputs, label, weight, key) to files of blocks; no two attempts write the same file, and the listing says which count."""
    schema = pa.schema([("path", pa.string()), ("rows", pa.int64())])

    def block(rows: pa.Table) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in rows.columns]
        if any(c.null_count for c in rows.columns) or any(np.isnan(c).any() for c in columns[:-1]):
            raise ValueError("inputs, labels and weights must not be null")
        *inputs, label, weight, key = columns
        if not np.isin(label, (0.0, 1.0)).all() or (weight < 0).any():
            raise ValueError("labels must be 0 or 1, weights 0 or more")
        bins = np.stack([np.searchsorted(e, v, "left") for e, v in zip(plan.edges, inputs)]).astype(bin_type(plan.bins))
        weight = np.rint(weight * WEIGHT_STEPS) / WEIGHT_STEPS
        path = f"{folder}/b{uuid.uuid4().hex}"
        save(path, (bins, plan.codes(bins), weight, (2 * label - 1).astype(np.int8), key.view(np.uint64)))
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


class Block:
    """The arrays of a block. A new round adds margins and gradients; without one they are read from the ``state`` of the round."""

    def __init__(self, plan: Plan, path: str, rows: int, state: str | None = None, whole: bool = True) -> None:
        self.plan, self.margin = plan, None
        kinds = [(bin_type(plan.bins), (len(plan.edges), rows)), (bin_type(max(CELLS, plan.bins)), (len(plan.groups()), rows)), (np.float64, (rows,))]
        more = [(np.int8, (rows,)), (np.uint64, (rows,))] if whole else []
        self.bins, self.codes, self.weight, *self.rest = load(path, kinds + more)
        if state:
            self.gradient, *margin = load(state, [(np.int32, (rows,)), (np.float64, (rows,))][: 1 + whole])
            self.margin = margin[0] if whole else None
        self.node, self.level = np.zeros(rows, np.int64), 0

    def descend(self, tree: Tree, level: int) -> None:
        tree.down(self.bins, self.node, level - self.level)
        self.level = level

    def begin(self, number: int, last: Tree | None) -> None:
        """Add the last tree to the margins, draw the rows of the round and find their gradients."""
        plan, (sign, key) = self.plan, self.rest
        if last is None:
            self.margin, gradient = np.zeros(len(sign)), sign.astype(np.float64)
        else:
            self.descend(last, plan.depth)
            scale = 1.0 if number == 1 else plan.step
            self.margin = self.margin + scale * last.values().take(self.node)
            with np.errstate(over="ignore"):
                gradient = 4.0 * sign / (1.0 + np.exp(2.0 * sign * self.margin))
        drawn = (uniform(key, number) < plan.rate) & (self.weight > 0)
        self.gradient = np.where(drawn, np.rint(gradient * plan.steps), _UNDRAWN).astype(np.int32)
        self.node, self.level = np.zeros(len(sign), np.int64), 0

    def sums(self, tree: Tree, level: int, slots: np.ndarray) -> np.ndarray:
        """Whole numbers by (statistic, slot, input, bin): weights, weighted gradients and, if asked for, rows; ``slots`` holds each node's place or -1."""
        plan, number = self.plan, int(slots.max()) + 1
        self.descend(tree, level)
        place = slots.take(self.node)
        rows = np.flatnonzero((place >= 0) & (self.gradient != _UNDRAWN))
        place, weight = place.take(rows), self.weight.take(rows) * WEIGHT_STEPS
        values = [weight, weight * self.gradient.take(rows)]
        if plan.least_rows > 1:
            values.append(np.ones(len(rows)))
        found = np.zeros((len(values), number, len(plan.edges), plan.bins), np.int64)
        for group, codes in zip(plan.groups(), self.codes):
            shape = [len(plan.edges[f]) + 1 for f in group]
            code = place * math.prod(shape) + codes.take(rows)
            for k, v in enumerate(values):
                cells = np.bincount(code, v, number * math.prod(shape)).reshape(number, *shape)
                for i, f in enumerate(group):
                    others = tuple(j + 1 for j in range(len(group)) if j != i)
                    found[k, :, f, : shape[i]] = np.rint(cells.sum(axis=others))
        return found


def uniform(key: np.ndarray, number: int) -> np.ndarray:
    """Numbers in [0, 1) from keys and the number of a round, each bit of which depends on all bits of both."""
    with np.errstate(over="ignore"):
        x = key + np.uint64(number + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


# ---- growing -------------------------------------------------------------------------------------


class Held:
    """Passes over blocks that a task holds."""

    def __init__(self, plan: Plan, files: Iterable[tuple[str, int]]) -> None:
        self.blocks = [Block(plan, path, rows) for path, rows in files]

    def begin(self, number: int, last: Tree | None) -> None:
        for b in self.blocks:
            b.begin(number, last)

    def sums(self, tree: Tree, level: int, slots: np.ndarray) -> np.ndarray:
        return sum(b.sums(tree, level, slots) for b in self.blocks)


class Dealt:
    """Passes over blocks in the shared folder, a job each; the root's sums come with the pass that begins a round."""

    def __init__(self, plan: Plan, spark, files: list[tuple[str, int]], folder: str) -> None:
        self.plan, self.spark, self.folder, self.state = plan, spark, folder, None
        tasks = min(len(files), spark.sparkContext.defaultParallelism)
        dealt, load_of = [[] for _ in range(tasks)], [0] * tasks
        for path, rows in sorted(files, key=lambda f: (-f[1], f[0])):
            least = load_of.index(min(load_of))
            dealt[least].append((path, rows))
            load_of[least] += rows
        self.tasks = spark.sparkContext.parallelize(dealt, tasks)

    def begin(self, number: int, last: Tree | None) -> None:
        plan, before, folder = self.plan, self.state, f"{self.folder}/round-{number}"
        root = Tree()
        root.add(0.0, 0.0)

        def run(files: list[tuple[str, int]]) -> tuple[dict[str, str], np.ndarray]:
            paths, found = {}, 0
            for path, rows in files:
                block = Block(plan, path, rows, before and before[path])
                block.begin(number, last)
                paths[path] = f"{folder}/s{uuid.uuid4().hex}"
                save(paths[path], (block.gradient, block.margin))
                found = found + block.sums(root, 0, np.zeros(1, np.int64))
            return paths, found

        parts = self.tasks.map(run).collect()
        self.state, self.root = {k: v for paths, _ in parts for k, v in paths.items()}, sum(s for _, s in parts)
        if number:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/round-{number - 1}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)

    def sums(self, tree: Tree, level: int, slots: np.ndarray) -> np.ndarray:
        if level == 0:
            return self.root
        plan, state = self.plan, self.state

        def run(files: list[tuple[str, int]]) -> np.ndarray:
            return sum(Block(plan, path, rows, state[path], whole=False).sums(tree, level, slots) for path, rows in files)

        found = self.tasks.map(run)
        return sum(found.collect()) if found.getNumPartitions() <= SUMS_AT_ONCE else found.treeReduce(lambda a, b: a + b)


def best_splits(plan: Plan, sums: np.ndarray, allowed: np.ndarray, least_weight: float) -> tuple[np.ndarray, ...]:
    """Per node the input, bin and gain of its best split (gain -1 where there is none), and the weight and total of its left side."""
    weight, total = sums[0] / WEIGHT_STEPS, sums[1] / (float(WEIGHT_STEPS) * plan.steps)
    left_w, left_t = (np.cumsum(x, 2)[:, :, :-1] for x in (weight, total))
    all_w, all_t = weight[:, 0].sum(1)[:, None, None], total[:, 0].sum(1)[:, None, None]
    right_w, right_t = all_w - left_w, all_t - left_t
    valid = allowed[:, :, None] & (left_w > 0) & (right_w > 0) & (left_w >= least_weight) & (right_w >= least_weight)
    if plan.least_rows > 1:
        left_n = np.cumsum(sums[2], 2)[:, :, :-1]
        valid &= (left_n >= plan.least_rows) & (sums[2][:, 0].sum(1)[:, None, None] - left_n >= plan.least_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left_t**2 / left_w + right_t**2 / right_w - all_t**2 / all_w) / all_w
    gain = np.where(valid & (gain > 0) & (gain >= plan.least_gain), gain, -1.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    at = np.arange(len(gain))
    f, b = np.divmod(best, gain.shape[2])
    return f, b, flat[at, best], left_w[at, f, b], left_t[at, f, b], all_w[:, 0, 0], all_t[:, 0, 0]


def grow(plan: Plan, passes) -> list[Tree]:
    """All trees, one after the other and level by level."""
    trees: list[Tree] = []
    inputs = len(plan.edges)
    for number in range(plan.rounds):
        passes.begin(number, trees[-1] if trees else None)
        tree, level, nodes = Tree(), 0, [0]
        tree.add(0.0, 0.0)
        known = passes.sums(tree, 0, np.zeros(1, np.int64))
        tree.weight[0], tree.total[0] = float(known[0, 0, 0].sum() / WEIGHT_STEPS), float(known[1, 0, 0].sum() / (WEIGHT_STEPS * plan.steps))
        least = plan.least_weight * tree.weight[0]
        while level < plan.depth:
            allowed = np.zeros((len(nodes), inputs), bool)
            for i, node in enumerate(nodes):
                allowed[i, np.random.default_rng([plan.seed, number, node]).permutation(inputs)[: plan.inputs]] = True
            f, b, gain, left_w, left_t, all_w, all_t = best_splits(plan, known, allowed, least)
            split = [i for i in range(len(nodes)) if gain[i] > 0]
            lighter, following = [], []
            for i in split:
                node = nodes[i]
                left = tree.add(float(left_w[i]), float(left_t[i]))
                right = tree.add(float(all_w[i] - left_w[i]), float(all_t[i] - left_t[i]))
                tree.feature[node], tree.bin[node], tree.left[node], tree.gain[node] = int(f[i]), int(b[i]), left, float(gain[i])
                lighter.append(left if tree.weight[left] <= tree.weight[right] else right)
                following += [left, right]
            level += 1
            if level == plan.depth or not split:
                break
            slots = np.full(len(tree.left), -1, np.int64)
            slots[lighter] = np.arange(len(lighter))
            some = passes.sums(tree, level, slots)
            others = known[:, split] - some
            known = np.empty((some.shape[0], 2 * len(split), *some.shape[2:]), np.int64)
            for k, node in enumerate(lighter):
                first = node == following[2 * k]
                known[:, 2 * k], known[:, 2 * k + 1] = (some[:, k], others[:, k]) if first else (others[:, k], some[:, k])
            nodes = following
        trees.append(tree)
    return trees


# ---- the model -----------------------------------------------------------------------------------


def model_of(estimator: GBTClassifier, plan: Plan, trees: list[Tree], spark) -> GBTClassificationModel:
    """The trees as a model of the library: written as it writes one, and read by it. Impurities, which prediction and importances don't use, are left at 0."""
    path = fresh_path(spark, "boosted-model")

    def described(kind: str, uid: str, params: dict, **more) -> str:
        return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": {}} | more)

    own = {p.name: v for p, v in estimator.extractParamMap().items() if p.name not in ("validationIndicatorCol", "thresholds")}
    tree_params = {n: own[n] for n in ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed")}
    whole = described("org.apache.spark.ml.classification.GBTClassificationModel", estimator.uid, own, numFeatures=len(plan.edges), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    kind = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    heads = [(i, described(kind, f"dtr_{uuid.uuid4().hex[:12]}", tree_params), plan.step if i else 1.0) for i in range(len(trees))]
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = []
    for i, tree in enumerate(trees):
        # the library reads children by number and expects those of a depth-first walk
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            if tree.left[node] != node:
                stack += [tree.left[node] + 1, tree.left[node]]
        place = {node: k for k, node in enumerate(order)}
        values = tree.values()
        for node in order:
            inner = tree.left[node] != node
            children = (place[tree.left[node]], place[tree.left[node] + 1]) if inner else (-1, -1)
            split = (tree.feature[node], [float(plan.edges[tree.feature[node]][tree.bin[node]])], -1) if inner else (-1, [], -1)
            stats = [tree.weight[node], tree.total[node], 0.0]
            nodes.append((i, (place[node], float(values[node]), 0.0, stats, -1, tree.gain[node], *children, split)))
    split = "split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
    data = f"id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, rightChild: int, {split.replace(' ', ': ', 1)}"
    spark.createDataFrame(nodes, f"treeID int, nodeData struct<{data}>").coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def inputs_per_node(strategy: str, inputs: int) -> int:
    """How many inputs a node may split on, as the library reads the setting."""
    named = {"auto": inputs, "all": inputs, "sqrt": math.ceil(math.sqrt(inputs)), "log2": max(1, math.ceil(math.log2(inputs))), "onethird": math.ceil(inputs / 3.0)}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit():
        return min(int(strategy), inputs)
    return math.ceil(float(strategy) * inputs)


def fit_boosted(estimator: GBTClassifier, rows: DataFrame, columns: Iterable[str], keys: Iterable[str], edges: Iterable[Iterable[float]]) -> GBTClassificationModel:
    """Boosted trees of ``rows``, which hold the columns, label, weight and keys; ``edges`` are the limits between the bins of each column. A value on a limit is below it."""
    spark, columns = rows.sparkSession, list(columns)
    if estimator.isSet("validationIndicatorCol"):
        raise ValueError("a fit that stops early by a validation set is not built")
    weight = F.col(estimator.getWeightCol()) if estimator.isSet("weightCol") else F.lit(1.0)
    label = F.col(estimator.getLabelCol())
    total = rows.agg(F.sum(weight.cast("double"))).first()[0]
    if not total:
        raise ValueError("no rows to fit")
    # the gradient's size is 4 at most
    bits = min(MOST_BITS, max(LEAST_BITS, EXACT_BITS - math.ceil(math.log2(total * 4 * WEIGHT_STEPS))))
    plan = Plan(
        rounds=estimator.getMaxIter(), depth=estimator.getMaxDepth(), step=estimator.getStepSize(), rate=estimator.getSubsamplingRate(),
        inputs=inputs_per_node(estimator.getFeatureSubsetStrategy(), len(columns)), least_rows=estimator.getMinInstancesPerNode(),
        least_weight=estimator.getMinWeightFractionPerNode(), least_gain=estimator.getMinInfoGain(), seed=abs(estimator.getSeed()),
        edges=[np.array(list(e), np.float64) for e in edges], steps=1 << bits,
    )
    with tidied(spark):
        folder = fresh_path(spark, "boosted")
        wanted = rows.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)], label.cast("double").alias("_y"), weight.cast("double").alias("_w"), F.xxhash64(F.lit(plan.seed), *keys).alias("_k"))
        listed = wanted.mapInArrow(packed(plan, f"{folder}/blocks"), _BLOCK).collect()
        files = sorted((r["path"], r["rows"]) for r in listed)
        if sum(n for _, n in files) <= ROWS_IN_A_TASK:
            trees = spark.sparkContext.parallelize([files], 1).map(lambda f: grow(plan, Held(plan, f))).collect()[0]
        else:
            trees = grow(plan, Dealt(plan, spark, files, folder))
        return model_of(estimator, plan, trees, spark)
