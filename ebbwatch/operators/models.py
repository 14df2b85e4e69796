"""Training, search, scoring and saving of churn models on Spark ML."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.features import positive_probability
from ebbwatch.operators.forests import GridForest
from ebbwatch.operators.metrics import binary_metrics
from ebbwatch.operators.networks import fit_weighted
from ebbwatch.operators.scoring import add_risk_bands
from ebbwatch.operators.splits import add_fold, split_by_hash
from ebbwatch.sources.storage import materialize

# Default settings of each model type. A forest keeps the node of each row and tree, or every level would
# walk all trees from their roots again for every row; the trees are the same.
DEFAULTS: dict[str, tuple[type, dict]] = {
    "random_forest": (
        GridForest,
        {"numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 10, "featureSubsetStrategy": "sqrt", "seed": 42, "cacheNodeIds": True},
    ),
    "gbt": (GBTClassifier, {"maxIter": 100, "maxDepth": 6, "stepSize": 0.05, "seed": 42}),
    "logistic": (LogisticRegression, {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}),
}
# Default search grids.
GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {"maxDepth": [4, 6, 8], "numTrees": [100, 200]},
    "gbt": {"maxDepth": [4, 6, 8], "maxIter": [100, 200]},
    "logistic": {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
}
# Fixed value: rows times weights of a network from which it is fitted to distinct rows with their copies.
WEIGHTED_FROM = 1 << 28
# Rows of boosted trees from which they are dealt out evenly, and rows of a partition at most.
DEALT_FROM = 1 << 16
DEALT_ROWS = 1 << 19
# Fixed value: rows from which the forests of a grid search are grown on binned rows.
GROWN_FROM = 1 << 16
BOOSTED = {"maxIter": 500, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}


def classifier(kind: str, label: str = "churn_label", features: str = "features", **settings):
    """Classifier of a known type with its defaults; an unknown type is an error."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model type {kind!r}; known: {', '.join(sorted(DEFAULTS))}")
    factory, defaults = DEFAULTS[kind]
    return factory(labelCol=label, featuresCol=features, **{**defaults, **settings})


def dealt(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Rows of a large table in even partitions, one for each core or a multiple of that; smaller tables stay as they lie.

    Boosted trees pass all rows once for each level of each tree, and every partition of a pass costs a task and sends
    the sums of all nodes. The order inside a partition is fixed by the rows, because the trainer lays kept predictions
    beside rows that may be read again.
    """
    rows = df.count()
    if rows < DEALT_FROM:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-rows // (cores * DEALT_ROWS)))
    others = [c for c in df.columns if c not in (label, features)]
    return df.repartition(parts).sortWithinPartitions(F.xxhash64(vector_to_array(features)), label, *others)


def fit_classifier(df: DataFrame, kind: str, label: str = "churn_label", features: str = "features", **settings):
    """Fit on the two columns that matter, so that nothing else is computed or carried along."""
    rows = df.select(label, features)
    return classifier(kind, label, features, **settings).fit(dealt(rows, label, features) if kind == "gbt" else rows)


def _grid(estimator, values: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def _auc(label: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def cross_validate(
    df: DataFrame,
    kind: str,
    key: str,
    folds: int = 5,
    grid: Mapping[str, Sequence] | None = None,
    label: str = "churn_label",
    parallelism: int = 4,
    **settings,
):
    """Grid search over hash folds of the key; returns the CrossValidatorModel.

    Forests of one fold that differ in depth only come from one fit; from ``GROWN_FROM`` rows on they are grown on binned rows.
    """
    estimator = classifier(kind, label, **settings)
    if isinstance(estimator, GridForest):
        estimator = estimator.on_binned_rows(GROWN_FROM)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=_grid(estimator, GRIDS[kind] if grid is None else grid),
        evaluator=_auc(label),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=42,
    )
    folded = add_fold(df.select(key, label, "features"), key, folds)
    return search.fit(folded.drop(key))


@dataclass
class Search:
    """Settings that were tried, their AUC on the held-out part, and the model of the best one."""

    settings: list[dict[str, float]]
    validationMetrics: list[float]
    bestModel: object


def tune_search(
    df: DataFrame, kind: str, key: str, grid: Mapping[str, Sequence] | None = None, candidates: int = 4, label: str = "churn_label",
    seed: int = 42, parallelism: int = 4,
) -> Search:
    """Random search: a few settings drawn from the grid, judged on a part held out by the hash of the key.

    The rows are written once and the settings are fitted side by side.
    """
    estimator = classifier(kind, label)
    full = _grid(estimator, GRIDS[kind] if grid is None else grid)
    drawn = random.Random(seed).sample(full, min(candidates, len(full)))
    parts = materialize(split_by_hash(df.select(key, label, "features"), key, name="_part"), "search")
    train, held = (parts.where(F.col("_part") == p).select(label, "features") for p in ("train", "test"))

    def attempt(setting):
        model = estimator.fit(train, setting)
        return model, float(_auc(label).evaluate(model.transform(held)))

    with ThreadPool(parallelism) as pool:
        models, aucs = map(list, zip(*pool.map(inheritable_thread_target(df.sparkSession)(attempt), drawn), strict=True))
    best = models[max(range(len(aucs)), key=aucs.__getitem__)]
    return Search([{p.name: float(v) for p, v in s.items()} for s in drawn], aucs, best)


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight 1 for negatives, negatives / positives for positives (a scalar subquery)."""
    ratio = df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(F.lit(1.0)))


def train_boosted_weighted(
    df: DataFrame, held_out: str, label: str = "churn_label", validation_tol: float = 0.01, **settings
):
    """Boosted trees with row and column sampling, positive weight and early stop.

    ``held_out`` is a boolean column that marks the validation rows.
    """
    weighted = with_class_weight(df.select(label, "features", held_out), label)
    trees = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        weightCol="weight",
        validationIndicatorCol=held_out,
        validationTol=validation_tol,
        **{**BOOSTED, **settings},
    )
    return trees.fit(dealt(weighted, label))


def with_copies(df: DataFrame, label: str, name: str = "_copies") -> DataFrame:
    """How often each row stands when positives are repeated until the classes are about even."""
    weighted = with_class_weight(df, label, "_w")
    return weighted.withColumn(name, F.greatest(F.round("_w").cast("int"), F.lit(1))).drop("_w")


def replicate_positives(df: DataFrame, label: str) -> DataFrame:
    """Positives repeated until the classes are about even, for models without a weight column.

    The copies come from an explode inside the task, so they stay with their partition.
    """
    copied = with_copies(df, label)
    return copied.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def train_mlp(
    df: DataFrame, n_features: int, hidden: Sequence[int] = (64, 32, 16), label: str = "churn", features: str = "features", max_iter: int = 200, balance: bool = True
):
    """Feed-forward network. Spark's hidden layers are sigmoid and it has neither dropout nor
    weights; class balance comes from repeated positives.

    From ``WEIGHTED_FROM`` on the same sum over all rows is taken over distinct rows with the number of their copies.
    """
    rows = df.select(label, features)
    layers = [n_features, *hidden, 2]
    network = MultilayerPerceptronClassifier(
        layers=layers, labelCol=label, featuresCol=features, maxIter=max_iter, blockSize=128, seed=42
    )
    if rows.count() * sum((n + 1) * m for n, m in zip(layers, layers[1:])) >= WEIGHTED_FROM:
        copied = with_copies(rows, label) if balance else rows.withColumn("_copies", F.lit(1))
        return fit_weighted(network, copied, "_copies")
    return network.fit(replicate_positives(rows, label) if balance else rows)


def text_classifier(label: str, text: str = "text", buckets: int = 1 << 14, **settings) -> Pipeline:
    """Binary classifier on hashed TF-IDF of the whole text."""
    tokens = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[\p{L}\p{N}]+", gaps=False)
    counts = HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=buckets)
    idf = IDF(inputCol="_counts", outputCol="features", minDocFreq=2)
    return Pipeline(stages=[tokens, counts, idf, classifier("logistic", label, **settings)])


def score_customers(model, df: DataFrame) -> DataFrame:
    """Probability of leaving, risk level and action for every row."""
    rated = model.transform(df).withColumn("churn_probability", positive_probability())
    return add_risk_bands(rated)


def score_rows(model, spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """The same scoring for a few literal rows."""
    return score_customers(model, spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema))


def evaluate(scored: DataFrame, label: str = "churn_label") -> DataFrame:
    """Metric rows of a scored frame."""
    return binary_metrics(scored, label, "churn_probability")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cluster_vectors(df: DataFrame, features: str, k: int, seed: int = 42):
    """k-means on vectors; returns the assigned frame and the model."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
    return model.transform(df), model
