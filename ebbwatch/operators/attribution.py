"""Path-dependent Shapley values of forests and boosted trees, row by row.

A saved ensemble is a table of nodes. Every leaf is flattened to the features on its path: the interval or categories
that lead to it, and the share of training rows that would follow if the feature were unknown. For one leaf the values
depend only on which of its features the row satisfies, so a batch of rows is reduced to the patterns that occur in
it, and the polynomial of Shapley weights is worked out once for each pattern.

base + contributions = prediction: the probability of a class for a forest, the margin for boosted trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.sources.storage import scratch_path


@dataclass(frozen=True)
class Leaf:
    """What a leaf adds to the prediction, and the different features on its path."""

    value: float
    features: np.ndarray
    low: np.ndarray  # not at or below this
    high: np.ndarray  # at or below this; infinite where nothing is asked
    share: np.ndarray  # of the rows at the tests of the feature that go on to the leaf
    categories: Mapping[int, np.ndarray]  # place on the path: which category numbers pass


@dataclass(frozen=True)
class Ensemble:
    leaves: Sequence[Leaf]
    base: float
    n_features: int


def node_table(model) -> DataFrame:
    """tree, id, prediction, stats, left, right, feature, cuts, categories: one row for each node of a fitted ensemble."""
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        node["impurityStats"].alias("stats"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("cuts"),
        node["split"]["numCategories"].alias("categories"),
    )


def flatten(model, label: int = 1) -> Ensemble:
    """The leaves of a forest (its probability of class ``label``) or of boosted trees (their margin).

    The driver holds the model's nodes, as it does when it fits them; their number does not depend on the rows.
    """
    if isinstance(model, RandomForestClassificationModel):
        weights = [1.0 / model.getNumTrees] * model.getNumTrees
        value = lambda n: n.stats[label] / sum(n.stats)
        cover = lambda n: sum(n.stats)
    elif isinstance(model, GBTClassificationModel):
        weights = list(model.treeWeights)
        value = lambda n: n.prediction
        cover = lambda n: n.stats[0]
    else:
        raise TypeError(f"no forest and no boosted trees: {type(model).__name__}")
    trees: dict[int, dict[int, object]] = {}
    for n in node_table(model).toLocalIterator():
        trees.setdefault(n.tree, {})[n.id] = n
    leaves, base = [], 0.0
    for tree, nodes in trees.items():
        left_to_do = [(nodes[0], {})]
        while left_to_do:
            n, path = left_to_do.pop()
            if n.left < 0:
                leaf = _leaf(weights[tree] * value(n), path)
                leaves.append(leaf)
                base += leaf.value * float(np.prod(leaf.share))
                continue
            for child, goes_left in ((nodes[n.left], True), (nodes[n.right], False)):
                low, high, share, passes = path.get(n.feature, (-np.inf, np.inf, 1.0, None))
                if n.categories >= 0:
                    inside = np.isin(np.arange(n.categories), np.array(n.cuts, int))
                    passes = (inside if goes_left else ~inside) & (True if passes is None else passes)
                elif goes_left:
                    high = min(high, n.cuts[0])
                else:
                    low = max(low, n.cuts[0])
                left_to_do.append((child, {**path, n.feature: (low, high, share * cover(child) / cover(n), passes)}))
    return Ensemble(leaves, base, model.numFeatures)


def _leaf(value: float, path: Mapping[int, tuple]) -> Leaf:
    features = sorted(path)
    low, high, share = (np.array([path[f][i] for f in features], float) for i in range(3))
    categories = {i: path[f][3] for i, f in enumerate(features) if path[f][3] is not None}
    return Leaf(value, np.array(features, int), low, high, share, categories)


def _weights(m: int) -> np.ndarray:
    """Shapley weight of a coalition of s out of the m - 1 other features."""
    return np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])


def _values_of_patterns(met: np.ndarray, leaf: Leaf) -> np.ndarray:
    """For rows of met features (patterns x features), what each feature of the path contributes."""
    n, m = met.shape
    weights, out = _weights(m), np.empty((n, m))
    for j in range(m):
        # Coefficients, by size of the coalition, of the product over the other features of (share + met * y).
        terms = np.zeros((n, m))
        terms[:, 0] = 1.0
        for k in range(m):
            if k != j:
                grown = terms * leaf.share[k]
                grown[:, 1:] += terms[:, :-1] * met[:, k : k + 1]
                terms = grown
        out[:, j] = leaf.value * (met[:, j] - leaf.share[j]) * (terms @ weights)
    return out


def shapley_values(ensemble: Ensemble, x: np.ndarray) -> np.ndarray:
    """Contributions of each feature (rows x features) to the predictions of the rows of x."""
    out = np.zeros((ensemble.n_features, len(x)))
    columns = np.ascontiguousarray(x.T)
    for leaf in ensemble.leaves:
        m = len(leaf.features)
        if not m:
            continue
        pattern = np.zeros(len(x), np.int64)
        for i, f in enumerate(leaf.features.tolist()):
            if i in leaf.categories:
                passes = leaf.categories[i]
                met = passes[np.clip(columns[f].astype(np.int64), 0, len(passes) - 1)]
            else:
                met = ~(columns[f] <= leaf.low[i])
                if leaf.high[i] < np.inf:
                    met &= columns[f] <= leaf.high[i]
            pattern |= met.astype(np.int64) << i
        if m <= 16:
            present = np.flatnonzero(np.bincount(pattern, minlength=1 << m))
            place = np.zeros(1 << m, np.int64)
            place[present] = np.arange(len(present))
            place = place[pattern]
        else:
            present, place = np.unique(pattern, return_inverse=True)
        bits = (present[:, None] >> np.arange(m) & 1).astype(float)
        values = _values_of_patterns(bits, leaf)
        for i, f in enumerate(leaf.features.tolist()):
            out[f] += values[place, i]
    return out.T


def tree_contributions(model, df: DataFrame, key: str, features: str = "features", label: int = 1, batch_rows: int = 10_000) -> DataFrame:
    """key, base, contributions (one for each entry of the vector) of every row, scored in Arrow batches in place.

    Rows with a null vector have null contributions. A not-a-number is above every cut, as it is for the trees.
    The patterns of a leaf are worked out once for each batch, so larger batches cost less for each row.
    """
    ensemble = flatten(model, label)
    shared = df.sparkSession.sparkContext.broadcast(ensemble)  # the model, which is on every executor that scores
    rows = df.select(F.col(key), F.when(F.col(features).isNotNull(), vector_to_array(features)).alias("_x"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                vectors = part.column("_x")
                known = vectors.is_valid().to_numpy(zero_copy_only=False)
                x = vectors.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, trees.n_features)
                flat = pa.array(shapley_values(trees, x).ravel())
                ends = np.append(0, np.cumsum(known)) * trees.n_features
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat, mask=pa.array(~known))
                base = pa.array(np.full(part.num_rows, trees.base))
                yield pa.RecordBatch.from_arrays([part.column(key), base, lists], [key, "base", "contributions"])

    return rows.mapInArrow(run, f"`{key}` {kind}, base double, contributions array<double>")


def mean_contributions(contributions: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, importance: the mean absolute contribution of each entry over the rows that have one."""
    cells = contributions.where("contributions is not null").select(F.posexplode("contributions").alias("at", "value"))
    means = cells.groupBy("at").agg(F.avg(F.abs("value")).alias("importance"))
    labels = F.array(*[F.lit(n) for n in names])
    return means.select(F.get(labels, F.col("at")).alias("feature"), "importance")
