"""Reproducible splits and folds from key hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.functions.scalar import hash_bucket
from ebbwatch.operators.ranks import hashed_positions


def split_by_hash(df: DataFrame, key: str, train_percent: int = 80, name: str = "part") -> DataFrame:
    """Adds train / test by the key's hash: no shuffle, the same for every partitioning."""
    return df.withColumn(name, F.when(hash_bucket(key, 100) < train_percent, "train").otherwise("test"))


def split_stratified(
    df: DataFrame, key: str, label: str, shares: Sequence[tuple[str, float]], name: str = "part"
) -> DataFrame:
    """Assigns parts so that each label is divided in the same shares, up to rounding.

    Rows without a label are a stratum of their own. ``shares`` are cumulative upper bounds in order, e.g. ``(("train", 0.8), ("test", 1.0))``.
    """
    placed = hashed_positions(df, key, [label], name="_at")
    result = None
    for part, upper in shares[:-1]:
        inside = F.col("_at") <= F.floor(F.col("_at_of") * F.lit(upper))
        result = F.when(inside, part) if result is None else result.when(inside, part)
    return placed.withColumn(name, result.otherwise(shares[-1][0])).drop("_at", "_at_of")


TWO_WAY = (("train", 0.8), ("test", 1.0))
# 15 % test, then 17.6 % of the rest for validation
THREE_WAY = (("train", 0.85 * (1 - 0.176)), ("validation", 0.85), ("test", 1.0))


def add_fold(df: DataFrame, key: str, folds: int = 5, name: str = "fold") -> DataFrame:
    return df.withColumn(name, hash_bucket(key, folds, salt="fold:").cast("int"))


def union_classes(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Both frames stacked and dealt out by key hash, which mixes the classes."""
    return first.unionByName(second).repartition(F.md5(F.col(key).cast("string")))


def expand_counts(df: DataFrame, key: str, count: str, item: str = "item", chunk: int = 10_000) -> DataFrame:
    """``count`` rows for each row, numbered from 1.

    A count is first cut into chunks, which are spread over the tasks, so that one huge count is
    not unfolded by a single task.
    """
    chunks = df.where(F.col(count) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / chunk).cast("int")))
    )
    first = F.col("_chunk") * chunk + 1
    last = F.least(first + (chunk - 1), F.col(count))
    return chunks.repartition(key, "_chunk").withColumn(item, F.explode(F.sequence(first, last))).drop("_chunk")


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows chosen by key hash: a top-n per task, then a merge of the winners."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
