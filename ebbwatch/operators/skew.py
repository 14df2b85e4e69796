"""Joins in which a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is heavy; there are at most 1 / HEAVY_SHARE of them.
HEAVY_SHARE = 0.001


def heavy_keys(counts: DataFrame, keys: Sequence[str], n: str = "n", share: float = HEAVY_SHARE) -> DataFrame:
    """The keys that hold more than ``share`` of all rows, from a frame with the number of rows of each key.

    Their shares sum to one at most, so there are fewer than 1 / share: a bound that does not depend on the data.
    """
    total = counts.agg(F.sum(n)).scalar()
    return counts.where(F.col(n) > total * share).select(*keys)


def heavy_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    counts: DataFrame | None = None,
    n: str = "n",
    how: str = "inner",
    share: float = HEAVY_SHARE,
    salts: int = 64,
) -> DataFrame:
    """``rows`` joined with ``table`` on keys of which null equals null; the keys stand once in the result.

    Rows of heavy keys are dealt over ``salts`` places by a hash of all their columns, and the table's rows of these
    keys, and only these, are repeated for each place. All other keys join as they are. ``counts`` has the rows of
    each key where they are known; else they are counted, with partial counts before the shuffle. Rows that are equal
    in every column stay together. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    keys = list(keys)
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count("*").alias(n))
    heavy = F.broadcast(heavy_keys(counts, keys, n, share).withColumnsRenamed({k: f"_heavy_{k}" for k in keys}).withColumn("_is_heavy", F.lit(True)))

    def marked(frame: DataFrame) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys]
        return frame.join(heavy, same, "left").drop(*[f"_heavy_{k}" for k in keys])

    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int")
    left = marked(rows).withColumn("_salt", F.when(F.col("_is_heavy"), place).otherwise(0)).drop("_is_heavy")
    places = F.when(F.col("_is_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = marked(table).withColumn("_place", F.explode(places)).drop("_is_heavy")
    right = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(right, [*same, F.col("_salt") == F.col("_place")], how).drop("_salt", "_place", *[f"_of_{k}" for k in keys])
