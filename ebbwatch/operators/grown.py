"""Forests grown on binned rows: the steps of Spark's forest for large tables, a tree at a time inside each task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.sources.storage import scratch_path

# Rows of a packed block, and rows of a partition at most.
BLOCK_ROWS = 2_048
PARTITION_ROWS = 1 << 19
# Fixed value: rows of a node, on the mean, from which its counts are taken by themselves and not with those of all nodes.
SEGMENT_ROWS = 4_096
# Fixed values of Spark's trees: rows from which the split candidates come, and the impurity that counts as none.
CANDIDATE_ROWS = 10_000
PURE = 2.0**-52

# How often a row stands in the bootstrap of a tree: Poisson of mean 1 by the inverse of its distribution. 16 random bits
# decide nearly always; where they do not (255), further ones are drawn.
_CDF = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(20)])
_FIRST, _LAST = (np.searchsorted(_CDF, (np.arange(1 << 16) + end) / (1 << 16), "right") for end in (0.0, 1.0))
_COUNTS = np.where(_FIRST == _LAST, _FIRST, 255).astype(np.uint8)


def bootstrap(n: int, *key: int) -> np.ndarray:
    """How often each of ``n`` rows is drawn; the same for the same key."""
    rng = np.random.Generator(np.random.SFC64(key))
    bits = np.frombuffer(rng.bytes(2 * n), np.uint16)
    counts = _COUNTS[bits]
    open_ = np.flatnonzero(counts == 255)
    counts[open_] = np.searchsorted(_CDF, (bits[open_] + rng.random(len(open_))) / (1 << 16), "right")
    return counts


def split_candidates(values: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between the values of a feature, as Spark's trees choose them: all, or about ``most`` at even counts."""
    found, counts = np.unique(values[~np.isnan(values)] + 0.0, return_counts=True)
    if len(found) < 2:
        return np.empty(0)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = counts.sum() / (most + 1)
    target, kept = stride, []
    until = np.cumsum(counts)
    for i in range(len(middles)):
        if abs(until[i] - target) < abs(until[i + 1] - target):
            kept.append(middles[i])
            target += stride
    return np.array(kept)


def _features_of_node(strategy: str, n: int, trees: int) -> int | None:
    """How many features a node looks at; None for what Spark's trainer has to tell."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    return {"all": n, "sqrt": math.ceil(math.sqrt(n)), "onethird": math.ceil(n / 3.0), "log2": max(1, math.ceil(math.log2(n)))}.get(strategy)


@dataclass
class Tree:
    """Nodes in the order of their growth, the root first; children are -1 at a leaf."""

    counts: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)

    def leaf(self, counts: Sequence[int]) -> int:
        for column, value in ((self.counts, tuple(counts)), (self.gain, -1.0), (self.left, -1), (self.right, -1), (self.feature, -1), (self.threshold, 0.0)):
            column.append(value)
        return len(self.gain) - 1

    def down_to(self, depth: int) -> list[tuple[int, int, int, int]]:
        """(node, prediction, left, right) down to a depth and numbered anew, parents first; as in training, two leaves
        with one prediction are one leaf."""
        out: list = []

        def add(at: int, level: int) -> None:
            here = len(out)
            if self.left[at] < 0 or level == depth:
                out.append((at, int(self.counts[at][1] > self.counts[at][0]), -1, -1))
                return
            out.append(None)
            add(self.left[at], level + 1)
            right = len(out)
            add(self.right[at], level + 1)
            if len(out) == here + 3 and out[-1][1] == out[-2][1]:
                out[here:] = [(at, out[-1][1], -1, -1)]
            else:
                out[here] = (at, int(self.counts[at][1] > self.counts[at][0]), here + 1, right)

        add(0, 0)
        return out


def _gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of two-class counts along the last axis; 0 without any."""
    whole = counts.sum(axis=-1)
    share = counts / np.maximum(whole, 1)[..., None]
    return np.where(whole > 0, 1.0 - (share * share).sum(axis=-1), 0.0)


def _packed(rows: DataFrame, candidates: Sequence[np.ndarray]) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` rows: bin and label in one byte, feature by feature."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(candidates))
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)
            codes = np.array([np.searchsorted(c, x[:, f]).astype(np.uint8) * 2 + label for f, c in enumerate(candidates)], np.uint8)
            blocks = [codes[:, at : at + BLOCK_ROWS].tobytes() for at in range(0, len(label), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["codes"])

    return rows.mapInArrow(pack, "codes binary")


def _dealt(packed: DataFrame, n_features: int, parts: int) -> RDD:
    """One matrix (feature, row) for each partition; the blocks are dealt evenly, in an order that does not change."""

    def numbered(part: int, rows: Iterable) -> Iterator[tuple]:
        for i, row in enumerate(rows):
            yield (part, i), bytes(row.codes)

    def joined(blocks: Iterable[tuple]) -> Iterator[np.ndarray]:
        held = [np.frombuffer(b, np.uint8).reshape(n_features, -1) for _, b in sorted(blocks)]
        if held:
            yield np.concatenate(held, axis=1)

    return packed.rdd.mapPartitionsWithIndex(numbered).partitionBy(parts, lambda key: key[0] * 7_919 + key[1]).mapPartitions(joined)


def _counts(codes: np.ndarray, features: np.ndarray, rows: np.ndarray, weight: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Weighted counts by node, feature looked at, bin and label; the rows lie in the order of their nodes."""
    nodes, looked_at = features.shape
    sums = np.empty((nodes, looked_at, width), np.uint32)
    rows, weight = rows.astype(np.intp), weight.astype(float)
    if len(rows) >= nodes * SEGMENT_ROWS:
        ends = np.cumsum([0, *sizes])
        for node, (begin, end) in enumerate(zip(ends, ends[1:])):
            for i, f in enumerate(features[node]):
                sums[node, i] = np.bincount(codes[f].take(rows[begin:end]), weight[begin:end], width)
        return sums
    place = np.repeat(np.arange(nodes) * width, sizes)
    for i in range(looked_at):
        cells = codes.reshape(-1).take(np.repeat(features[:, i] * codes.shape[1], sizes) + rows)
        sums[:, i] = np.bincount(cells + place, weight, nodes * width).reshape(nodes, width)
    return sums


def _roots(looked_at: Mapping[int, np.ndarray], drawn_of: Callable[[int, int, int], np.ndarray], width: int):
    """For each tree: the rows it draws, how often each, how many lie in each node, and the counts of its root."""

    def start(part: int, blocks: Iterable[np.ndarray]) -> Iterator:
        for codes in blocks:
            yield codes
            for tree, features in looked_at.items():
                drawn = drawn_of(part, tree, codes.shape[1])
                rows = np.flatnonzero(drawn)
                weight, sizes = drawn[rows], np.array([len(rows)])
                yield tree, rows.astype(np.int32), weight, sizes, _counts(codes, features, rows, weight, sizes, width)

    return start


def _children(splits: Mapping[int, tuple], looked_at: Mapping[int, np.ndarray], last: bool, width: int):
    """Rows go from their nodes to the children that are split further, which are counted; ``last`` keeps the counts only."""

    def move(items: Iterable) -> Iterator:
        items = iter(items)
        for codes in items:
            yield codes
            for tree, rows, weight, sizes, _ in items:
                if tree not in splits:
                    continue
                feature, most, below = splits[tree]
                features = looked_at[tree]
                nodes = len(features)
                right = codes.reshape(-1).take(np.repeat(feature * codes.shape[1], sizes) + rows) > np.repeat(most, sizes)
                # A child that is not split further has the place after all others.
                child = below.reshape(-1).take(np.repeat(np.arange(len(below)) * 2, sizes) + right)
                sizes = np.bincount(child, minlength=nodes + 1)[:nodes]
                order = np.argsort(child, kind="stable")[: sizes.sum()]
                rows, weight = rows[order], weight[order]
                sums = _counts(codes, features, rows, weight, sizes, width)
                yield (tree, None, None, None, sums) if last else (tree, rows, weight, sizes, sums)

    return move


def _best(looked_at: Mapping[int, np.ndarray], splits_of: np.ndarray, min_rows: int, min_gain: float):
    """The best split of each node of a tree: which feature and bin, gain, counts on the left and of the node."""

    def best(parts: Iterable[tuple[int, np.ndarray]]) -> Iterator[tuple]:
        merged: dict[int, np.ndarray] = {}
        for tree, sums in parts:
            if tree in merged:
                merged[tree] += sums
            else:
                merged[tree] = sums.astype(np.int64)
        for tree, sums in merged.items():
            features = looked_at[tree]
            nodes = len(features)
            left = sums.reshape(*sums.shape[:2], -1, 2).cumsum(axis=2)
            whole = left[:, :1, -1:]
            left = left[:, :, :-1]
            right = whole - left
            n_left, n_right, n = left.sum(axis=-1), right.sum(axis=-1), whole.sum(axis=-1)
            gain = _gini(whole) - n_left / n * _gini(left) - n_right / n * _gini(right)
            allowed = (n_left >= min_rows) & (n_right >= min_rows) & (gain >= min_gain)
            allowed &= np.arange(left.shape[2]) < splits_of[features][..., None]
            gain = np.where(allowed, gain, -np.inf).reshape(nodes, -1)
            at = gain.argmax(axis=1)
            slot, cut = np.divmod(at, left.shape[2])
            every = np.arange(nodes)
            yield tree, features[every, slot], cut, gain[every, at], left[every, slot, cut], whole[:, 0, 0]

    return best


def _split(trees: Sequence[Tree], open_: Mapping[int, list[int]], found: Iterable[tuple], candidates: Sequence[np.ndarray], root: bool, last: bool):
    """Grows the children of the nodes that have a split; the nodes to split next and, for the rows, how to get there."""
    further, splits = {}, {}
    for t, feature, cut, gain, left, whole in found:
        tree, right, below = trees[t], whole - left, []
        impure = np.stack([_gini(left) >= PURE, _gini(right) >= PURE], axis=1) & (gain > 0)[:, None] & (not last)
        for i, at in enumerate(open_[t]):
            if root:
                tree.counts[at] = tuple(whole[i].tolist())
            if gain[i] > 0:
                tree.feature[at], tree.gain[at] = int(feature[i]), float(gain[i])
                tree.threshold[at] = float(candidates[feature[i]][cut[i]])
                tree.left[at], tree.right[at] = children = [tree.leaf(side[i].tolist()) for side in (left, right)]
                below += [child for child, inner in zip(children, impure[i], strict=True) if inner]
        if below:
            places = np.where(impure, impure.cumsum().reshape(-1, 2) - 1, len(below)).astype(np.min_scalar_type(len(below)))
            further[t], splits[t] = below, (feature.astype(np.int64), (2 * cut + 1).astype(np.uint8), places)
    return further, splits


class Grown:
    """The trees of a forest and its models of any lesser depth. The driver holds the nodes, as Spark's trainer does."""

    def __init__(self, frame: RandomForestClassificationModel, trees: list[Tree]):
        self.frame, self.trees, self.spark = frame, trees, SparkSession.active()
        self.columns = [{c: np.array(getattr(tree, c)) for c in ("counts", "gain", "feature", "threshold")} for tree in trees]

    def at(self, depth: int) -> RandomForestClassificationModel:
        """Spark's model of the trees down to a depth."""
        parts = []
        for number, (tree, own) in enumerate(zip(self.trees, self.columns, strict=True)):
            at, prediction, left, right = np.array(tree.down_to(depth)).T
            inner = left >= 0
            parts.append({
                "tree": np.full(len(at), number), "id": np.arange(len(at)), "prediction": prediction, "left": left, "right": right,
                "negatives": own["counts"][at, 0], "positives": own["counts"][at, 1], "gain": np.where(inner, own["gain"][at], -1.0),
                "feature": np.where(inner, own["feature"][at], -1), "threshold": own["threshold"][at],
            })
        flat = self.spark.createDataFrame(pa.table({c: np.concatenate([p[c] for p in parts]) for c in parts[0]}))
        path = scratch_path(self.spark, "forest-grown")
        self.frame.write().save(path)
        schema = self.spark.read.parquet(f"{path}/data").schema
        n = F.col("negatives") + F.col("positives")
        share = lambda c: F.col(c) / n
        node = {
            "id": F.col("id"), "prediction": F.col("prediction"),
            "impurity": F.when(n > 0, 1.0 - share("negatives") * share("negatives") - share("positives") * share("positives")).otherwise(0.0),
            "impurityStats": F.array(F.col("negatives").cast("double"), F.col("positives").cast("double")),
            "rawCount": n, "gain": F.col("gain"), "leftChild": F.col("left"), "rightChild": F.col("right"),
            "split": F.struct(
                F.col("feature").alias("featureIndex"),
                F.when(F.col("left") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                F.lit(-1).alias("numCategories"),
            ),
        }
        rows = flat.select(F.col("tree").alias("treeID"), F.struct(*[v.alias(k) for k, v in node.items()]).alias("nodeData"))
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


def _frame(estimator: RandomForestClassifier, n_features: int, frames: dict) -> RandomForestClassificationModel:
    """A model of Spark with the settings asked for, whose trees are put in later; ``frames`` keeps one of each size."""
    size = (n_features, estimator.getNumTrees())
    if size not in frames:
        rows = [(Vectors.dense([float(y)] * n_features), float(y)) for y in (0, 1)]
        shape = SparkSession.active().createDataFrame(rows, [estimator.getFeaturesCol(), estimator.getLabelCol()]).coalesce(1)
        frames[size] = RandomForestClassifier._fit(estimator.copy({estimator.maxDepth: 1, estimator.cacheNodeIds: False}), shape)
    return estimator._copyValues(frames[size].copy())


def _plain(estimator: RandomForestClassifier, dataset: DataFrame) -> bool:
    """Whether the settings and features are those that are grown here; Spark's trainer takes all others."""
    attributes = dataset.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (
        estimator.getImpurity() == "gini" and estimator.getSubsamplingRate() == 1.0 and not estimator.isSet(estimator.weightCol)
        and not estimator.isSet(estimator.thresholds) and estimator.getMinWeightFractionPerNode() == 0.0 and estimator.getMaxBins() <= 127
        and 1 <= estimator.getMaxDepth() <= 16 and not {"nominal", "binary"} & set(attributes)
        and estimator.getFeatureSubsetStrategy() in ("auto", "all", "sqrt", "log2", "onethird")
        and not dataset.schema[estimator.getLabelCol()].metadata.get("ml_attr")
    )


def grow(estimator: RandomForestClassifier, dataset: DataFrame, from_rows: int, frames: dict) -> Grown | None:
    """The trees of a forest, or None for tables of fewer rows and for what only Spark's trainer knows.

    Every step is that of Spark's forest: split candidates from about 10,000 rows, a bootstrap of all rows for each tree,
    a draw of features for each node, the best gain over the bins of all rows. Random numbers are others. A task takes one
    tree after the other, its rows in the order of their nodes, so that the counts of a node stay in the processor's
    cache; rows that a tree does not draw are left out. The counts of a tree are added up by one task, which chooses its
    splits. Between levels, executors keep five bytes for each row that a tree draws; the driver holds the nodes.
    """
    if not _plain(estimator, dataset):
        return None
    spark = dataset.sparkSession
    label = F.col(estimator.getLabelCol()).cast("double").alias("label")
    rows = dataset.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), label)
    odd = F.count_if(F.col("x").isNull() | F.col("label").isNull() | ~F.col("label").isin(0.0, 1.0))
    number, odd, positives, least, most = rows.agg(F.count("*"), odd, F.sum("label"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if number < from_rows or odd or not 0 < positives < number or least != most or not most:
        return None
    n_features, n_trees, seed = most, estimator.getNumTrees(), estimator.getSeed()
    wanted = max(estimator.getMaxBins() ** 2, CANDIDATE_ROWS)
    some = rows.sample(False, wanted / number, seed) if wanted < number else rows
    sample = np.array([r.x for r in some.select("x").collect()], float).reshape(-1, n_features)
    candidates = [split_candidates(sample[:, f], estimator.getMaxBins() - 1) for f in range(n_features)]
    splits_of = np.array([len(c) for c in candidates])
    width = 2 * (max(1, int(splits_of.max())) + 1)
    per_node = _features_of_node(estimator.getFeatureSubsetStrategy(), n_features, n_trees)
    key = seed % (1 << 64)
    bagged = estimator.getBootstrap()

    def drawn_of(part: int, tree: int, n: int) -> np.ndarray:
        return bootstrap(n, key, n_trees, tree, part) if bagged else np.ones(n, np.uint8)

    cores = spark.sparkContext.defaultParallelism
    parts = min(cores * max(1, -(-number // (cores * PARTITION_ROWS))), -(-number // BLOCK_ROWS))
    blocks = _dealt(_packed(rows, candidates), n_features, parts)
    trees = [Tree() for _ in range(n_trees)]
    open_ = {t: [tree.leaf((0, 0))] for t, tree in enumerate(trees)}
    state, splits, levels = None, {}, estimator.getMaxDepth()
    try:
        for level in range(levels):
            looked_at = {}
            for t, nodes in open_.items():
                rng = np.random.Generator(np.random.SFC64((key, n_trees, t, level, 1)))
                every = np.tile(np.arange(n_features), (len(nodes), 1))
                looked_at[t] = rng.permuted(every, axis=1)[:, :per_node] if per_node < n_features else every
            old, last = state, level + 1 == levels
            if old is None:
                state = blocks.mapPartitionsWithIndex(_roots(looked_at, drawn_of, width))
            else:
                state = old.mapPartitions(_children(splits, looked_at, last, width))
            if not last:
                state = state.persist(StorageLevel.MEMORY_AND_DISK)
            counts = state.mapPartitions(lambda items: ((item[0], item[4]) for item in items if isinstance(item, tuple)))
            best = _best(looked_at, splits_of, estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
            found = counts.partitionBy(min(parts, len(open_)), int).mapPartitions(best).collect()
            if old is not None:
                old.unpersist()
            open_, splits = _split(trees, open_, found, candidates, level == 0, last)
            if not open_:
                break
    finally:
        if state is not None:
            state.unpersist()
    return Grown(_frame(estimator, n_features, frames), trees)
