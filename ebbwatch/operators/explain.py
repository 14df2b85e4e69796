"""Which inputs drive a score."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.operators.features import positive_probability
from ebbwatch.operators.metrics import grouped_auc
from ebbwatch.operators.ranks import hashed_positions


def linear_contributions(df: DataFrame, weights: Sequence[tuple[str, float]]) -> DataFrame:
    """Mean absolute ``weight * (x - mean)`` per feature.

    For a linear score this is the exact additive attribution of independent features. Nulls take
    no part. The means are one row, read as a scalar subquery.
    """
    names = [n for n, _ in weights]
    means = df.agg(F.struct(*[F.avg(n).alias(n) for n in names]).alias("m")).scalar()
    shifted = df.select(*names, means.alias("_m"))
    spread = shifted.agg(
        *[F.avg(F.abs(F.lit(float(w)) * (F.col(n) - F.col("_m")[n]))).alias(n) for n, w in weights]
    )
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in names])
    return spread.select(F.inline(cells))


def vector_contributions(df: DataFrame, coefficients: Sequence[float], names: Sequence[str], features: str = "features") -> DataFrame:
    """``linear_contributions`` of a fitted linear model over a vector column."""
    columns = [f"_x{i}" for i in range(len(names))]
    cells = vector_to_array(features)
    wide = df.select(*[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(columns)])
    rated = linear_contributions(wide, list(zip(columns, coefficients)))
    labels = F.create_map(*[F.lit(v) for pair in zip(columns, names) for v in pair])
    return rated.withColumn("feature", labels[F.col("feature")])


def importance_rank(importances: DataFrame, top: int | None = 10) -> DataFrame:
    """Features by falling importance, with the share of the largest; ties by name."""
    largest = importances.agg(F.max("importance")).scalar()
    rated = importances.withColumn("relative", F.try_divide(F.col("importance"), largest))
    ordered = rated.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)


def _few_rows(spark: SparkSession, names: Sequence[str], values) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def tree_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    return _few_rows(spark, names, model.featureImportances.toArray())


def mlp_input_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Mean absolute first-layer weight per input.

    Weights are stored layer by layer; the first block holds, input after input, one weight for each
    neuron of the first hidden layer.
    """
    layers = model.getLayers()
    inputs, neurons = layers[0], layers[1]
    first = np.asarray(model.weights.toArray()[: inputs * neurons]).reshape(inputs, neurons)
    return _few_rows(spark, names, np.abs(first).mean(axis=1))


def _with_donor(index: int):
    """The row's vector with one entry taken from its donor."""
    return F.transform("_x", lambda x, p: F.when(p == index, F.get("_donor", p)).otherwise(x))


def permutation_importance(model, df: DataFrame, key: str, label: str, names: Sequence[str], features: str = "features") -> DataFrame:
    """Drop of AUC when one entry of the vector is exchanged between rows.

    Every row gets a donor: the row at the same position of a second hash order. That is one join on
    unique positions for all features; the exchanged vectors are made inside the row.
    """
    rows = df.select(key, label, vector_to_array(features).alias("_x"))
    mine = hashed_positions(rows, key, salt="own:", name="_at").drop("_at_of")
    donors = hashed_positions(rows.select(key, "_x"), key, salt="donor:", name="_at")
    paired = mine.join(donors.select("_at", F.col("_x").alias("_donor")), "_at")
    base = F.struct(F.lit("(none)").alias("feature"), F.col("_x").alias("_v"))
    exchanged = [F.struct(F.lit(n).alias("feature"), _with_donor(i).alias("_v")) for i, n in enumerate(names)]
    variants = paired.select(label, F.inline(F.array(base, *exchanged))).withColumn(features, array_to_vector("_v"))
    scores = model.transform(variants).withColumn("_p", positive_probability())
    areas = grouped_auc(scores, label, "_p", "feature")
    # one row for each feature
    whole = areas.agg(F.max(F.when(F.col("feature") == "(none)", F.col("auc_roc")))).scalar()
    return areas.where("feature <> '(none)'").select("feature", (whole - F.col("auc_roc")).alias("importance"))
