"""Boosted trees over cells instead of rows: what ``GBTRegressor`` learns, at a cost that hardly grows with the rows.

A tree of squared error sees a row by its binned features alone, and of the labels only their count, sum and sum of squares. So the rows are
counted once by cell (the bins of all features, as one number) and label; each tree draws its row sample from these counts and the levels'
histograms are sums over cells. The learner is that of Spark's ``GradientBoostedTrees``: the first tree is fitted to the label, the
others to twice the residual with the step as weight; a node looks at a random share of the features; categories are
ordered by their mean; thresholds lie midway between values, in groups of equal weight.

* **Row sample.** Rows of one cell and label cannot be told apart, so how many of them a sample without replacement keeps is a binomial
  draw. The draws depend on the counts, the seed and the tree, not on the order, the partitions or the cores.
* **Size.** Counts are spread by cell over blocks of about ``BLOCK_ROWS``; a task holds one block. Each block draws its samples of several trees
  in one job. Up to ``CELLS_HERE`` cells, their sums of each tree come to the driver, which grows the trees (``CellsHere``). Beyond, cells
  stay in their blocks, and each level of a tree brings one histogram per block (``CellsSpread``): up to a cell for every row. Both
  draw the same samples and give the same trees.
* **Loss of an executor.** Counts are stored in the checkpoint folder; spread blocks are kept with disk behind memory, and stored every
  ``checkpointInterval`` trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import checkpoint_root, materialize

#: counts (cell, label) of one task
BLOCK_ROWS = 250_000
#: quantiles of a feature that its thresholds are chosen from
QUANTILES = 4096
PACKED = "codes binary, starts binary, labels binary, rows binary, cells bigint"
#: most cells whose sums come to the driver, and bytes of such sums in one job
CELLS_HERE = 500_000
SUMS_BYTES = 64_000_000


# ---------------------------------------------------------------- bins

def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` cuts midway between the sorted ``values``, with about equal weight between them."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = weights.sum() / (most + 1)
    found, target = [], stride
    for i, current in enumerate(np.cumsum(weights)[1:]):
        if abs(current - weights[i + 1] - target) < abs(current - target):
            found.append(middle[i])
            target += stride
    return np.array(found[:most])


def find_bins(vectors: DataFrame, categories: list[int], most: int) -> list[np.ndarray | int]:
    """Per feature its thresholds, or the number of its categories (``categories``: 0 for a continuous one)."""
    numeric = [i for i, k in enumerate(categories) if not k]
    points = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
    columns = vectors.select(*[F.get("x", F.lit(i)).alias(f"x{i}") for i in numeric])
    cuts = dict(zip(numeric, columns.approxQuantile(columns.columns, points, 0.25 / QUANTILES) if numeric else []))
    return [k or thresholds(*np.unique(np.array(cuts[i], float), return_counts=True), most - 1) for i, k in enumerate(categories)]


def cell_numbers(x: np.ndarray, bins: list[np.ndarray | int], bits: int) -> np.ndarray:
    """A row's bins as one number; a value equal to a threshold lies below it, NaN above all."""
    code = np.zeros(len(x), np.int64)
    for i, b in enumerate(bins):
        code |= (x[:, i].astype(np.int64) if isinstance(b, int) else np.searchsorted(b, x[:, i], side="left")) << (bits * i)
    return code


def _counted(bins: list[np.ndarray | int], bits: int):
    """Arrow batches of (x, y) -> (code, y, n), the rows of a batch counted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                # as Spark's own fit refuses them
                if np.isnan(y).any():
                    raise ValueError("a label is null or NaN")
                if not np.isfinite(x).all():
                    raise ValueError("a feature is NaN or infinite")
                code = cell_numbers(x, bins, bits)
                at = np.lexsort((y, code))
                code, y = code[at], y[at]
                first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (y[1:] != y[:-1])])
                yield pa.RecordBatch.from_arrays([pa.array(code[first]), pa.array(y[first]), pa.array(np.diff(np.r_[first, len(y)]))], ["code", "y", "n"])
    return count


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's counts, sorted by cell, as one row of arrays."""
    held = [b for b in batches if b.num_rows]
    if held:
        code, y, n = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(3))
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        arrays = (code[starts].astype(np.int64), starts.astype(np.int64), y.astype(np.float64), n.astype(np.int64))
        yield pa.RecordBatch.from_arrays([*[pa.array([a.tobytes()], pa.binary()) for a in arrays], pa.array([len(starts)], pa.int64())],
                                         ["codes", "starts", "labels", "rows", "cells"])


def cell_counts(vectors: DataFrame, bins: list[np.ndarray | int], bits: int) -> DataFrame:
    """Blocks of cells with their labels' counts, stored. Number and contents of the blocks depend on the rows alone."""
    counts = materialize(vectors.mapInArrow(_counted(bins, bits), "code bigint, y double, n bigint")
                         .groupBy("code", "y").agg(F.sum("n").alias("n")))
    blocks = max(1, math.ceil(counts.count() / BLOCK_ROWS))
    return materialize(counts.repartition(blocks, "code").sortWithinPartitions("code", "y").mapInArrow(_packed, PACKED))


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """A whole binary tree by node number (children of i: 2i + 1, 2i + 2). ``feature`` is -1 at a leaf; ``left`` tells by bin who goes left."""

    feature: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    @classmethod
    def of_depth(cls, depth: int, most: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros((n, most), bool), np.zeros(n), np.zeros(n), np.zeros((n, 3)))


class Cells:
    """Some cells: their bins, the ensemble's prediction, and of the current tree's sample count, sum and squares of the target."""

    def __init__(self, codes: np.ndarray, features: int, bits: int):
        self.bins = np.stack([(codes >> (bits * i)) & (2 ** bits - 1) for i in range(features)]).astype(np.uint8 if bits <= 8 else np.int64)
        self.predicted = np.zeros(len(codes))
        self.sums: tuple[np.ndarray, ...] = ()

    def add(self, tree: Tree, weight: float, depth: int) -> None:
        self.predicted = self.predicted + weight * tree.value[self.nodes(tree, depth)]

    def aim(self, n: np.ndarray, s: np.ndarray, q: np.ndarray, first: bool) -> None:
        """The first tree's target is the label, the others' twice the residual."""
        p = self.predicted
        self.sums = (n, s, q) if first else (n, 2 * (s - n * p), 4 * (q - 2 * p * s + n * p * p))

    def nodes(self, tree: Tree, levels: int) -> np.ndarray:
        node, cells = np.zeros(self.bins.shape[1], np.int64), np.arange(self.bins.shape[1])
        for _ in range(levels):
            feature = tree.feature[node]
            left = tree.left[node, self.bins[feature, cells]]
            node = np.where(feature >= 0, 2 * node + np.where(left, 1, 2), node)
        return node

    def histogram(self, tree: Tree, level: int, most: int) -> np.ndarray:
        """Count, sum and squares of the level's nodes, by feature and bin."""
        width, low = 2 ** level, 2 ** level - 1
        node = self.nodes(tree, level) - low
        node[node < 0] = width  # ended in a leaf above
        places = [node * most + b for b in self.bins]
        return np.stack([[np.bincount(p, x, (width + 1) * most).reshape(-1, most)[:width] for p in places] for x in self.sums], -1).swapaxes(0, 1)


@dataclass
class Fit:
    """What a fit's tasks know of it."""

    features: int
    bits: int
    most: int
    depth: int
    trees: int
    rate: float
    seed: int
    every: int


class Counts:
    """One block's counts of labels by cell."""

    def __init__(self, packed):
        self.codes, self.starts, self.labels, self.rows = (np.frombuffer(packed[i], np.float64 if i == 2 else np.int64) for i in range(4))

    def sample(self, seed: list[int], rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, sum and squares of the labels of a cell's sampled rows."""
        kept = self.rows.copy()
        if rate < 1:
            rng, one = np.random.default_rng(seed), self.rows == 1
            kept[one] = rng.random(int(one.sum())) < rate
            kept[~one] = rng.binomial(self.rows[~one], rate)
        n, s, q = (np.add.reduceat(x, self.starts) for x in (kept.astype(np.float64), kept * self.labels, kept * self.labels ** 2))
        return n, s, q


class CellsHere:
    """All cells in the driver; the blocks' samples come for several trees at once."""

    def __init__(self, blocks: DataFrame, cells: int, fit: Fit):
        self.fit = fit
        self.blocks = blocks.rdd.mapPartitionsWithIndex(lambda part, rows: ((part, Counts(r)) for r in rows))
        self.cells = Cells(np.concatenate(self.blocks.map(lambda b: b[1].codes).collect()), fit.features, fit.bits)
        self.at_once = max(1, SUMS_BYTES // (24 * cells))
        self.samples: dict[int, tuple[np.ndarray, ...]] = {}

    def next(self, t: int, before: Tree | None, weight: float) -> None:
        fit = self.fit
        if before is not None:
            self.cells.add(before, weight, fit.depth)
        if t not in self.samples:
            some = range(t, min(t + self.at_once, fit.trees))
            parts = self.blocks.map(lambda b: [b[1].sample([fit.seed, i, b[0]], fit.rate) for i in some]).collect()
            self.samples = {i: tuple(np.concatenate([p[k][j] for p in parts]) for j in range(3)) for k, i in enumerate(some)}
        self.cells.aim(*self.samples.pop(t), t == 0)

    def histogram(self, tree: Tree, level: int) -> np.ndarray:
        return self.cells.histogram(tree, level, self.fit.most)

    def close(self) -> None:
        self.samples = {}


class CellsSpread:
    """Cells in their blocks; a job for each level of a tree."""

    def __init__(self, blocks: DataFrame, fit: Fit):
        self.fit, self.held = fit, None
        checkpoint_root(blocks.sparkSession)

        def opened(part, rows):
            for r in rows:
                counts = Counts(r)
                yield part, counts, Cells(counts.codes, fit.features, fit.bits)

        self.state = blocks.rdd.mapPartitionsWithIndex(opened)

    def next(self, t: int, before: Tree | None, weight: float) -> None:
        fit, older = self.fit, self.held

        def step(block):
            part, counts, cells = block
            if before is not None:
                cells.add(before, weight, fit.depth)
            cells.aim(*counts.sample([fit.seed, t, part], fit.rate), t == 0)
            return part, counts, cells

        self.state = self.held = self.state.map(step).persist(StorageLevel.MEMORY_AND_DISK)
        if fit.every > 0 and t % fit.every == fit.every - 1:
            self.state.checkpoint()
        self.state.foreach(lambda _: None)  # before the older blocks go
        if older is not None:
            older.unpersist()

    def histogram(self, tree: Tree, level: int) -> np.ndarray:
        most = self.fit.most
        return sum(self.state.map(lambda b: b[2].histogram(tree, level, most)).collect())

    def close(self) -> None:
        if self.held is not None:
            self.held.unpersist()


def best_split(hist: np.ndarray, bins: list[np.ndarray | int], chosen: np.ndarray, fewest: float) -> tuple[float, int, np.ndarray | None]:
    """Of one node's histograms (feature, bin, (count, sum, squares)): the gain in squares, the feature, and who goes left by bin."""
    found: tuple[float, int, np.ndarray | None] = (0.0, -1, None)
    for f in chosen:
        n, s = hist[f, :, 0], hist[f, :, 1]
        size = bins[f] if isinstance(bins[f], int) else len(bins[f]) + 1
        order = np.arange(size)
        if isinstance(bins[f], int):
            # categories without rows come last
            order = np.lexsort((order, np.where(n[:size] > 0, s[:size] / np.maximum(n[:size], 1), np.inf)))
        nl, sl = np.cumsum(n[order])[:-1], np.cumsum(s[order])[:-1]
        nr, sr = n.sum() - nl, s.sum() - sl
        ok = (nl >= fewest) & (nr >= fewest)
        if ok.any():
            gain = np.where(ok, sl ** 2 / np.maximum(nl, 1) + sr ** 2 / np.maximum(nr, 1) - s.sum() ** 2 / max(n.sum(), 1), -np.inf)
            at = int(np.argmax(gain))
            if gain[at] > found[0]:
                left = np.zeros(hist.shape[1], bool)
                left[order[:at + 1]] = True
                found = (float(gain[at]), int(f), left)
    return found


def grow(tree: Tree, level: int, hist: np.ndarray, bins: list[np.ndarray | int], rng: np.random.Generator, share: int, fewest: float, least: float) -> bool:
    """Split a level's nodes by their histograms; whether any was split. The sums of the children are those of the bins that go there."""
    if level == 0:
        tree.stats[0] = hist[0, 0].sum(0)
        tree.value[0] = tree.stats[0, 1] / max(tree.stats[0, 0], 1)
    any_split = False
    for i in range(2 ** level):
        node = 2 ** level - 1 + i
        n, _, q = tree.stats[node]
        if level and tree.feature[(node - 1) // 2] < 0 or n <= 0:
            continue
        gain, feature, left = best_split(hist[i], bins, np.sort(rng.permutation(len(bins))[:share]), fewest)
        # a gain within the rounding of the sums is none
        if feature < 0 or gain / n < least or gain <= 1e-12 * q:
            continue
        tree.feature[node], tree.left[node], tree.gain[node] = feature, left, gain / n
        for child, side in ((2 * node + 1, left), (2 * node + 2, ~left)):
            tree.stats[child] = hist[i, feature, side].sum(0)
            tree.value[child] = tree.stats[child, 1] / tree.stats[child, 0]
        any_split = True
    return any_split


# ---------------------------------------------------------------- Spark's model of them

def _java_trees(spark: SparkSession, trees: list[Tree], bins, uid: str):
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    # each part of a class's name costs a call
    ml, calculator = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    leaf, internal, at, among = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
    wrap, kind, part = jvm.java.nio.ByteBuffer.wrap, ml.regression.DecisionTreeRegressionModel, jvm.java.util.Arrays.copyOfRange

    def doubles(values: np.ndarray):
        """An array of doubles by one call, not one for each value."""
        wrapped = wrap(np.asarray(values, ">f8").tobytes()).asDoubleBuffer()
        out = gateway.new_array(gateway.jvm.double, len(values))
        wrapped.get(out)
        return out

    def node(tree: Tree, i: int, stats):
        n, s, q = tree.stats[i]
        spread = max(float((q - s * s / n) / n), 0.0) if n else 0.0
        f = int(tree.feature[i])
        of = calculator(part(stats, 3 * i, 3 * i + 3), int(n))
        if f < 0:
            return leaf(float(tree.value[i]), spread, of)
        if isinstance(bins[f], int):
            split = among(f, doubles(np.flatnonzero(tree.left[i, :bins[f]])), bins[f])
        else:
            split = at(f, float(bins[f][int(tree.left[i].sum()) - 1]))
        return internal(float(tree.value[i]), spread, float(tree.gain[i]), node(tree, 2 * i + 1, stats), node(tree, 2 * i + 2, stats), split, of)

    out = gateway.new_array(kind, len(trees))
    for t, tree in enumerate(trees):
        out[t] = kind(f"{uid}_{t}", node(tree, 0, doubles(tree.stats.ravel())), len(bins))
    return out, doubles


class CellGBTRegressor(GBTRegressor):
    """``GBTRegressor`` of squared error, its parameters and its model; only the fit is made over cells."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        if self.getLossType() != "squared" or self.isSet("weightCol") or self.isSet("validationIndicatorCol"):
            raise ValueError("only squared error, without weights and validation rows")
        spark = dataset.sparkSession
        name = self.getFeaturesCol()
        attrs = (dataset.schema[name].metadata.get("ml_attr") or {}).get("attrs", {})
        kinds = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", [])}
        kinds |= {a["idx"]: 2 for a in attrs.get("binary", [])}
        vectors = dataset.select(vector_to_array(name).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        size = vectors.select(F.max(F.size("x"))).first()[0]
        if not size or size < 0:
            raise ValueError("no rows to fit")
        most, bits = self.getMaxBins(), (self.getMaxBins() - 1).bit_length()
        if bits * size > 62 or max(kinds.values(), default=0) > most:
            raise ValueError(f"{size} features of {most} bins do not fit one number, or one has more categories than bins")
        bins = find_bins(vectors, [kinds.get(i, 0) for i in range(size)], most)
        share = self._share(size)
        fewest, least = self.getMinInstancesPerNode(), self.getMinInfoGain()
        fit = Fit(size, bits, most, self.getMaxDepth(), self.getMaxIter(), self.getSubsamplingRate(), self.getSeed() % 2 ** 32, self.getCheckpointInterval())
        blocks = cell_counts(vectors, bins, bits)
        number = blocks.agg(F.sum("cells")).first()[0]
        cells = CellsHere(blocks, number, fit) if number <= CELLS_HERE else CellsSpread(blocks, fit)
        weights = [1.0] + [self.getStepSize()] * (fit.trees - 1)
        trees: list[Tree] = []
        for t in range(fit.trees):
            cells.next(t, trees[-1] if trees else None, weights[t - 1])
            tree, rng = Tree.of_depth(fit.depth, most), np.random.default_rng([fit.seed, t])
            for level in range(fit.depth):
                if not grow(tree, level, cells.histogram(tree, level), bins, rng, share, fewest, least):
                    break
            trees.append(tree)
        cells.close()
        java, doubles = _java_trees(spark, trees, bins, self.uid)
        made = spark.sparkContext._jvm.org.apache.spark.ml.regression.GBTRegressionModel(self.uid, java, doubles(np.array(weights)), size)
        return self._copyValues(GBTRegressionModel(made))

    def _share(self, size: int) -> int:
        """Features that a node looks at."""
        strategy = self.getFeatureSubsetStrategy()
        named = {"auto": size, "all": size, "sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(size))), "onethird": math.ceil(size / 3)}
        if strategy in named:
            return named[strategy]
        if strategy.isdigit() and int(strategy) > 0:
            return min(int(strategy), size)
        return math.ceil(float(strategy) * size)
