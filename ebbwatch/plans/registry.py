"""Registration of queries: a callable over (spark, folder) and, where it exists, the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.functions.scalar import round_half_up
from ebbwatch.operators.quality import raw_to_silver
from ebbwatch.operators.scoring import add_risk_bands, add_rule_score, add_vip, silver_to_gold
from ebbwatch.sources.snapshot import customer_raw

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


# ------------------------------------------------------------------------------ layers used by many


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return raw_to_silver(customer_raw(spark, folder)).drop("silver_ts")


def gold(spark: SparkSession, folder: str) -> DataFrame:
    return silver_to_gold(silver(spark, folder)).drop("gold_ts")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Gold with the rule score, its bands and the linear VIP score."""
    return gold(spark, folder).transform(add_rule_score).transform(add_risk_bands).transform(add_vip, "linear")


def six(column: Column | str) -> Column:
    return round_half_up(column, 6)


def micro_text(vector: Column | str) -> Column:
    """A vector as whole millionths in one string, for comparison across engines."""
    units = F.transform(vector, lambda x: F.floor(x * 1000000.0 + 0.5).cast("bigint").cast("string"))
    return F.array_join(units, ",")
