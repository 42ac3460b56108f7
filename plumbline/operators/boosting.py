"""Gradient boosting with second-order gains and best-first growth.

Features are cut into bins once and stored. Each round of a tree is one Spark aggregate: sums of gradients
and Hessians by (leaf, feature, bin) over all leaves that have no split yet. From these follow the best split of
each leaf, its gain and the weights of its children. Leaves are opened by gain until there are ``num_leaves``. The
fitted model is one of Spark's own boosted-tree models, so it scores in the JVM and is stored like any other.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted
from plumbline.session import delete_path, scratch_path

#: Trees between two writes of the rows with their predictions; a lost executor recomputes no more than these.
STORED_EVERY = 10
#: Sums that one aggregate brings to the driver at most; larger frontiers take several aggregates.
CELLS = 1 << 21
#: Gains closer than this share are ties, which the first feature and bin win.
SAME_GAIN = 1e-9


@dataclass
class Tree:
    """Nodes in lists: split feature and bin, children (-1 for a leaf), gradient and Hessian sums, gain."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    sums: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, 0.0)])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def open(self, node: int, feature: int, cut: int, gain: float, sums: tuple) -> list[int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = first, first + 1
        for s in sums:
            for values, v in ((self.feature, 0), (self.cut, 0), (self.left, -1), (self.right, -1), (self.depth, self.depth[node] + 1), (self.sums, s), (self.gain, 0.0)):
                values.append(v)
        return [first, first + 1]


@dataclass(frozen=True)
class Penalties:
    """What a leaf weighs and what a split must gain."""

    reg_lambda: float
    reg_alpha: float
    gamma: float
    min_child_weight: float
    min_child_samples: int

    def shrunk(self, g: np.ndarray) -> np.ndarray:
        return np.sign(g) * np.maximum(np.abs(g) - self.reg_alpha, 0.0)

    def score(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return self.shrunk(g) ** 2 / np.maximum(h + self.reg_lambda, 1e-300)

    def weight(self, g: float, h: float) -> float:
        return float(-self.shrunk(np.float64(g)) / max(h + self.reg_lambda, 1e-300)) if h > 0 else 0.0


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, rules: Penalties) -> tuple[float, int, int, tuple] | None:
    """(gain, feature, cut, sums of both children) of the best split, from sums by (feature, bin); none without a gain.

    The gain is half of what the scores of the children exceed that of the leaf by, less ``gamma``.
    """
    gl, hl, nl = (np.cumsum(x, axis=1)[:, :-1] for x in (g, h, n))
    g_all, h_all, n_all = (x.sum(axis=1, keepdims=True) for x in (g, h, n))
    gr, hr, nr = g_all - gl, h_all - hl, n_all - nl
    gain = 0.5 * (rules.score(gl, hl) + rules.score(gr, hr) - rules.score(g_all, h_all)) - rules.gamma
    least = max(rules.min_child_samples, 1)
    allowed = (np.minimum(nl, nr) >= least) & (np.minimum(hl, hr) >= rules.min_child_weight)
    gain = np.where(allowed, gain, -np.inf)
    top = gain.max(initial=-np.inf)
    if not top > 1e-12 * max(1.0, abs(float(rules.score(g_all, h_all).max()))):
        return None
    feature, cut = np.argwhere(gain >= top - SAME_GAIN * abs(top))[0]
    return float(gain[feature, cut]), int(feature), int(cut), (
        (float(gl[feature, cut]), float(hl[feature, cut])), (float(gr[feature, cut]), float(hr[feature, cut])))


class SecondOrderBoosting(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """Squared-error boosting whose leaves weigh -G / (H + reg_lambda), for G and H the sums of gradients and Hessians.

    A leaf is opened where the gain of its best split is positive after ``gamma`` and both children keep
    ``min_child_weight`` of Hessian and ``min_child_samples`` rows. With ``num_leaves`` 0 all such leaves above ``max_depth`` are
    opened, otherwise those of the highest gains first until the tree has that many. Rows of a tree are drawn
    by a hash of their stored place (``subsample``), features by the seed (``colsample_bytree``). Cuts are at values of
    the features: at most ``max_bin`` per feature, at its quantiles. Missing values go to the right.
    """

    n_estimators = Param(Params._dummy(), "n_estimators", "trees", TypeConverters.toInt)
    max_depth = Param(Params._dummy(), "max_depth", "levels of splits", TypeConverters.toInt)
    num_leaves = Param(Params._dummy(), "num_leaves", "leaves of a tree, 0 for no bound", TypeConverters.toInt)
    learning_rate = Param(Params._dummy(), "learning_rate", "share of each tree", TypeConverters.toFloat)
    subsample = Param(Params._dummy(), "subsample", "share of rows of a tree", TypeConverters.toFloat)
    colsample_bytree = Param(Params._dummy(), "colsample_bytree", "share of features of a tree", TypeConverters.toFloat)
    reg_lambda = Param(Params._dummy(), "reg_lambda", "penalty of squared weights", TypeConverters.toFloat)
    reg_alpha = Param(Params._dummy(), "reg_alpha", "penalty of absolute weights", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split", TypeConverters.toFloat)
    min_child_weight = Param(Params._dummy(), "min_child_weight", "least Hessian of a child", TypeConverters.toFloat)
    min_child_samples = Param(Params._dummy(), "min_child_samples", "least rows of a child", TypeConverters.toInt)
    max_bin = Param(Params._dummy(), "max_bin", "cuts of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", seed=42, n_estimators=100, max_depth=6,
        num_leaves=0, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0, reg_lambda=1.0, reg_alpha=0.0, gamma=0.0,
        min_child_weight=1.0, min_child_samples=1, max_bin=255,
    ):
        super().__init__()
        self._setDefault(
            n_estimators=100, max_depth=6, num_leaves=0, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0, reg_lambda=1.0,
            reg_alpha=0.0, gamma=0.0, min_child_weight=1.0, min_child_samples=1, max_bin=255)
        self._set(**self._input_kwargs)

    def _rules(self) -> Penalties:
        return Penalties(*(self.getOrDefault(p) for p in ("reg_lambda", "reg_alpha", "gamma", "min_child_weight", "min_child_samples")))

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        # Fits run side by side in a search, so each looks after its own tables.
        paths: list[str] = []
        try:
            trees, edges, base = self._grown(dataset, paths)
        finally:
            for path in paths:
                delete_path(dataset.sparkSession, path)
        return spark_model(
            dataset.sparkSession, trees, edges, base, self._rules(), self.getOrDefault("learning_rate"), self.getFeaturesCol(), self.getPredictionCol())

    def _grown(self, dataset: DataFrame, paths: list[str]) -> tuple[list[Tree], list[list[float]], float]:
        rows = dataset.select(quoted(self.getLabelCol()).cast("double").alias("y"), vector_to_array(quoted(self.getFeaturesCol())).alias("x"))
        first = rows.first()
        if first is None:
            raise ValueError("no rows to fit")
        width, most = len(first.x), self.getOrDefault("max_bin")
        edges, base = _edges(rows, width, most)
        plain = [f"f{i}" for i in range(width)]
        cuts = [[-math.inf, *(math.nextafter(e, math.inf) for e in own), math.inf] for own in edges]
        cut = Bucketizer(splitsArray=cuts, inputCols=plain, outputCols=[f"b{i}" for i in range(width)], handleInvalid="keep")
        binned = cut.transform(rows.select("y", *(F.col("x")[i].alias(p) for i, p in enumerate(plain)))).select(
            "y", F.array(*(F.col(f"b{i}").cast("int") for i in range(width))).alias("bins"), F.lit(base).alias("m"))
        frame = _stored(binned.withColumn("id", F.monotonically_increasing_id()), paths)
        rules, rate, seed = self._rules(), self.getOrDefault("learning_rate"), self.getSeed()
        chooser, trees = random.Random(seed), []
        # A bin more than cuts, for what lies above the last, and one for missing values.
        bins = max(len(own) for own in edges) + 2
        for t in range(self.getOrDefault("n_estimators")):
            chosen = sorted(chooser.sample(range(width), max(1, int(width * self.getOrDefault("colsample_bytree")))))
            drawn = frame
            if self.getOrDefault("subsample") < 1:
                place = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(t)), F.lit(1 << 20))
                drawn = frame.filter(place < F.lit(int(self.getOrDefault("subsample") * (1 << 20))))
            tree = self._tree(drawn, chosen, width, bins, rules)
            trees.append(tree)
            weights = [rules.weight(*s) for s in tree.sums]
            frame = frame.withColumn("m", F.col("m") + rate * on_bins(tree, weights))
            if (t + 1) % STORED_EVERY == 0 and t + 1 < self.getOrDefault("n_estimators"):
                frame = _stored(frame, paths)
        return trees, edges, base

    def _tree(self, rows: DataFrame, chosen: list[int], width: int, bins: int, rules: Penalties) -> Tree:
        leaves, deepest = self.getOrDefault("num_leaves"), self.getOrDefault("max_depth")
        tree, splits, ask = Tree(), {}, [0]
        while ask:
            for node, sums in _histograms(rows, tree, ask, chosen, width, bins).items():
                if node == 0:
                    tree.sums[0] = (float(sums[0][chosen[0]].sum()), float(sums[1][chosen[0]].sum()))
                found = best_split(*sums, rules) if deepest < 0 or tree.depth[node] < deepest else None
                if found:
                    splits[node] = found
            ask = []
            for node in _opened(tree, splits, leaves):
                if tree.left[node] < 0:
                    children = tree.open(node, splits[node][1], splits[node][2], splits[node][0], splits[node][3])
                    ask += children
            # Children at the last level have no split to find.
            ask = [n for n in ask if deepest < 0 or tree.depth[n] < deepest]
        return _pruned(tree, set(_opened(tree, splits, leaves)))


def _stored(df: DataFrame, paths: list[str]) -> DataFrame:
    """``df`` written to the shared folder; tables before the last one are not read again and go."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "boosting")
    df.write.parquet(path)
    while paths:
        delete_path(spark, paths.pop())
    paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _edges(rows: DataFrame, width: int, most: int) -> tuple[list[list[float]], float]:
    """Cut values of each feature, at its approximate quantiles, and the mean label."""
    base = rows.agg(F.avg("y")).first()[0]
    if base is None:
        raise ValueError("no labels to fit")
    plain = [f"f{i}" for i in range(width)]
    shares = [(i + 1) / (most + 1) for i in range(most)]
    found = rows.select(*(F.col("x")[i].alias(p) for i, p in enumerate(plain))).approxQuantile(plain, shares, 1 / (8 * most))
    return [sorted({float(v) for v in own if math.isfinite(v)}) or [0.0] for own in found], float(base)


def _opened(tree: Tree, splits: dict[int, tuple], leaves: int) -> list[int]:
    """The nodes that best-first growth opens, of those whose split is known.

    A node's turn comes by the least gain on its way from the root: what lies behind a small gain waits for it.
    """
    key, above = {}, {c: n for n in range(len(tree.left)) if tree.left[n] >= 0 for c in (tree.left[n], tree.right[n])}
    for node in range(len(tree.left)):
        if node in splits and (node == 0 or above[node] in key):
            key[node] = min(splits[node][0], key.get(above.get(node), math.inf))
    order = sorted(key, key=lambda n: (-key[n], tree.depth[n], n))
    return order[: leaves - 1] if leaves > 0 else order


def _pruned(tree: Tree, opened: set[int]) -> Tree:
    """The tree of the opened nodes; splits that were only looked at become leaves."""
    result, names = Tree(), {0: 0}
    result.sums[0] = tree.sums[0]
    todo = [0]
    while todo:
        node = todo.pop(0)
        if node in opened and tree.left[node] >= 0:
            left, right = tree.left[node], tree.right[node]
            names[left], names[right] = result.open(names[node], tree.feature[node], tree.cut[node], tree.gain[node], (tree.sums[left], tree.sums[right]))
            todo += [left, right]
    return result


def _histograms(rows: DataFrame, tree: Tree, nodes: list[int], chosen: list[int], width: int, bins: int) -> dict[int, tuple]:
    """Sums of gradients, Hessians and rows by (feature, bin) of each of ``nodes``; features not chosen stay empty."""
    found = {n: tuple(np.zeros((width, bins)) for _ in range(3)) for n in nodes}
    step = max(1, CELLS // (len(chosen) * bins))
    for begin in range(0, len(nodes), step):
        part = nodes[begin : begin + step]
        placed = rows.withColumn("leaf", on_bins(tree, range(len(tree.left))).cast("int")).filter(f"array_contains(array({', '.join(map(str, part))}), leaf)")
        cells = placed.select("leaf", (F.col("m") - F.col("y")).alias("g"), F.posexplode("bins").alias("feature", "bin"))
        if len(chosen) < width:
            cells = cells.filter(f"array_contains(array({', '.join(map(str, chosen))}), feature)")
        # The Hessian of a squared error is 1 in each row.
        sums = cells.groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n")).toArrow()
        leaf, feature, at, g, n = (sums.column(c).to_numpy() for c in ("leaf", "feature", "bin", "g", "n"))
        for node in part:
            own = leaf == node
            for table, values in zip(found[node], (g, n, n)):
                table[feature[own], at[own]] = values[own]
    return found


def _spark_tree(spark: SparkSession, tree: Tree, width: int, values: Sequence[float], thresholds: Sequence[float]):
    """Spark's tree model with these predictions of the nodes, in the JVM."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    nodes, calculator = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def stats(n: int):
        array = gateway.new_array(jvm.double, 3)
        array[0], array[1], array[2] = float(tree.sums[n][1]), float(-tree.sums[n][0]), 0.0
        return calculator(array, int(tree.sums[n][1]))

    made = {}
    # Children have greater numbers than their parents.
    for n in range(len(tree.left) - 1, -1, -1):
        own = stats(n)
        if tree.left[n] < 0:
            made[n] = nodes.LeafNode(float(values[n]), 0.0, own)
        else:
            split = nodes.ContinuousSplit(int(tree.feature[n]), float(thresholds[n]))
            made[n] = nodes.InternalNode(float(values[n]), 0.0, float(tree.gain[n]), made.pop(tree.left[n]), made.pop(tree.right[n]), split, own)
    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(
        jvm.org.apache.spark.ml.util.Identifiable.randomUID("tree"), made[0], width)


def on_bins(tree: Tree, values: Sequence[float]) -> Column:
    """The value of the leaf that the array ``bins`` of a row leads to.

    The tree is data of the plan (arrays), so the code that is compiled for one tree serves the next.
    """
    feature, cut, left, right = (f"array({', '.join(map(str, v))})" for v in (tree.feature, tree.cut, tree.left, tree.right))
    below = f"if(get(bins, get({feature}, n)) <= get({cut}, n), get({left}, n), get({right}, n))"
    leaf = f"aggregate(sequence(1, {max(tree.depth)}), 0, (n, i) -> if(get({left}, n) < 0, n, {below}))" if max(tree.depth) else "0"
    return F.expr(f"get(array({', '.join(f'{float(v)!r}D' for v in values)}), {leaf})")


def spark_model(
    spark: SparkSession, trees: list[Tree], edges: list[list[float]], base: float, rules: Penalties, rate: float, features: str, prediction: str,
) -> GBTRegressionModel:
    """Spark's boosted-tree model of these trees; the first tree is one leaf, the mean label."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    regression, width = jvm.org.apache.spark.ml.regression, len(edges)
    mean = Tree()
    mean.sums[0] = (-base, 1.0)
    array, shares = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees) + 1), gateway.new_array(jvm.double, len(trees) + 1)
    array[0], shares[0] = _spark_tree(spark, mean, width, [base], [0.0]), 1.0
    for i, tree in enumerate(trees):
        thresholds = [edges[f][c] if c < len(edges[f]) else math.inf for f, c in zip(tree.feature, tree.cut)]
        array[i + 1], shares[i + 1] = _spark_tree(spark, tree, width, [rules.weight(*s) for s in tree.sums], thresholds), float(rate)
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("boosting")
    return GBTRegressionModel(regression.GBTRegressionModel(uid, array, shares, width)).setFeaturesCol(features).setPredictionCol(prediction)
