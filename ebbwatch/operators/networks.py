"""Feed-forward networks on weighted rows: the objective of Spark's network over distinct rows with their counts."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.sources.storage import materialize

# Rows of a matrix block, and rows of a partition at most.
BLOCK_ROWS = 512
PARTITION_ROWS = 1 << 18


def weighted_rows(df: DataFrame, label: str, features: str, copies: str) -> DataFrame:
    """Each different pair of inputs ``x`` and ``label`` once, with the sum of its copies."""
    return df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("label"), copies).groupBy("x", "label").agg(
        F.sum(copies).cast("double").alias("weight")
    )


def _blocks(rows: Iterable, classes: int, inputs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Inputs, labels and weights in blocks; what Spark's network refuses is an error here too."""

    def block(xs, labels, weights):
        if any(x is None or len(x) != inputs for x in xs):
            raise ValueError(f"the features must be vectors of {inputs} numbers")
        if any(v is None or v not in range(classes) for v in labels):
            raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
        return np.array(xs, dtype=float), np.array(labels, dtype=int), np.array(weights, dtype=float)

    held: list = []
    for row in rows:
        held.append(row)
        if len(held) == BLOCK_ROWS:
            yield block(*zip(*held, strict=True))
            held = []
    if held:
        yield block(*zip(*held, strict=True))


def _layers(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the flat weights: a matrix (inputs, outputs) and a bias for each layer, in Spark's order."""
    at, found = 0, []
    for n, m in zip(layers, layers[1:]):
        found.append((weights[at : at + n * m].reshape(n, m), weights[at + n * m : at + n * m + m]))
        at += n * m + m
    return found


def weighted_gradient(weights: np.ndarray, layers: Sequence[int], blocks: Iterable) -> np.ndarray:
    """Weighted sums over the blocks: cross entropy, then its gradient. Hidden layers are sigmoid, the last softmax."""
    total = np.zeros(1 + len(weights))
    sums, model = _layers(total[1:], layers), _layers(weights, layers)
    with np.errstate(all="ignore"):
        for x, label, weight in blocks:
            outputs = [x]
            for i, (matrix, bias) in enumerate(model):
                z = outputs[-1] @ matrix
                z += bias
                if i < len(model) - 1:
                    z = np.exp(np.negative(z, out=z), out=z)
                    z += 1.0
                    outputs.append(np.reciprocal(z, out=z))
                else:
                    z -= z.max(axis=1, keepdims=True)
                    of_label = z[np.arange(len(z)), label]
                    np.exp(z, out=z)
                    norm = z.sum(axis=1)
                    total[0] += weight @ (np.log(norm) - of_label)
                    z /= norm[:, None]
                    outputs.append(z)
            delta = outputs[-1]
            delta[np.arange(len(delta)), label] -= 1.0
            delta *= weight[:, None]
            for i in range(len(model) - 1, -1, -1):
                sums[i][0][...] += outputs[i].T @ delta
                sums[i][1][...] += delta.sum(axis=0)
                if i:
                    delta = delta @ model[i][0].T
                    delta *= outputs[i]
                    delta *= 1.0 - outputs[i]
    return total


class _Stuck(Exception):
    """No step from here."""


def _step(f: Callable, x: np.ndarray, value: float, grad: np.ndarray, direction: np.ndarray, first: float):
    """Step of the strong Wolfe conditions (Nocedal and Wright, 3.5 and 3.6) along a direction: (t, value, grad)."""
    slope = float(grad @ direction)
    if not slope <= 0:
        raise _Stuck

    def at(t):
        v, g = f(x + direction * t)
        return t, v, float(g @ direction), g

    def zoom(low, high):
        for _ in range(10):
            left, right = (high, low) if low[0] > high[0] else (low, high)
            width = right[0] - left[0]
            d1 = left[2] + right[2] - 3 * (left[1] - right[1]) / -width
            d2 = np.sqrt(d1 * d1 - left[2] * right[2])
            t = right[0] - width * (right[2] + d2 - d1) / (right[2] - left[2] + 2 * d2)
            c = at(left[0] + 0.1 * width if t < left[0] + 0.1 * width else left[0] + 0.9 * width if t > left[0] + 0.9 * width else t)
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(slope):
                    return c
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Stuck

    low, t = (0.0, value, slope, grad), first
    for i in range(10):
        c = at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return c
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Stuck


def minimize(f: Callable, x: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10) -> tuple[np.ndarray, list[float]]:
    """Limited-memory BFGS with the settings and stops of Spark's trainer; the point and the values of all iterations.

    It stops after ``max_iter`` steps, if the value is within ``tol`` (of the first one) of the largest of the last 20,
    if the gradient is as small, or if no step is found twice in a row.
    """
    value, grad = f(x)
    values, recent, pairs, stuck = [value], deque([np.inf], maxlen=20), deque(maxlen=memory), False
    while len(values) <= max_iter:
        if np.linalg.norm(grad) <= max(tol * value, 1e-8) or (len(recent) > 1 and abs(value - max(recent)) <= tol * values[0]):
            break
        try:
            direction, scales = -grad, []
            for s, y in reversed(pairs):
                scales.append((s @ direction) / (s @ y))
                direction -= scales[-1] * y
            if pairs:
                s, y = pairs[-1]
                if not s @ y >= 0:
                    raise _Stuck
                direction *= (s @ y) / (y @ y)
            for (s, y), a in zip(pairs, reversed(scales), strict=True):
                direction += (a - (y @ direction) / (s @ y)) * s
            t, new_value, _, new_grad = _step(f, x, value, grad, direction, 1.0 if len(values) > 1 else 1.0 / np.linalg.norm(direction))
            if t * np.linalg.norm(grad) < 1e-10:
                raise _Stuck
        except _Stuck:
            if stuck:
                break
            stuck = True
            pairs.clear()
            continue
        stuck, moved = False, x + direction * t
        pairs.append((moved - x, new_grad - grad))
        x, value, grad = moved, new_value, new_grad
        values.append(value)
        recent.append(value)
    return x, values


def fit_weighted(network: MultilayerPerceptronClassifier, df: DataFrame, copies: str) -> MultilayerPerceptronClassificationModel:
    """Spark's network fitted to rows that stand ``copies`` times each, from the same first weights.

    Every evaluation is one pass over the distinct rows, held as matrix blocks by the executors; only the weights and
    one sum for each partition reach the driver. The mean is over rows, where Spark's trainer takes the mean of the
    means of its blocks, the last, shorter one of each partition included. Spark makes the model from the found weights.
    """
    spark, layers = df.sparkSession, network.getLayers()
    shape = spark.createDataFrame([(0.0, Vectors.dense([0.0] * layers[0]))], [network.getLabelCol(), network.getFeaturesCol()])
    first = network.copy({network.maxIter: 0}).fit(shape).weights.toArray()

    rows = materialize(weighted_rows(df, network.getLabelCol(), network.getFeaturesCol(), copies), "network-rows")
    number, whole = rows.agg(F.count("*"), F.sum("weight")).first()
    cores = spark.sparkContext.defaultParallelism
    parts = cores * max(1, -(-number // (cores * PARTITION_ROWS)))
    dealt = rows.repartition(parts, "x", "label").sortWithinPartitions("x", "label")
    blocks = dealt.rdd.mapPartitions(lambda some: _blocks(some, layers[-1], layers[0])).persist(StorageLevel.MEMORY_AND_DISK)

    def mean(weights):
        sums = blocks.mapPartitions(lambda some: [weighted_gradient(weights, layers, some)]).collect()
        total = np.sum(sums, axis=0) / whole
        return float(total[0]), total[1:]

    try:
        found, _ = minimize(mean, first, network.getMaxIter(), network.getTol())
    finally:
        blocks.unpersist()
    return network.copy({network.maxIter: 0, network.initialWeights: Vectors.dense(found)}).fit(shape)
