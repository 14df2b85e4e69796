"""Raw to silver: deduplication, types, defaults, validation and quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions.scalar import failed_checks


def dedup_latest(df: DataFrame, key: str, latest: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key (last write wins), with a total order behind it.

    Keeping rank 1 lets Spark limit each key to one row inside every input task before the
    shuffle, so a key with millions of versions never reaches one task.
    """
    order = [F.col(latest).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def enforce_types(df: DataFrame) -> DataFrame:
    """Age as int, money as double; a value that cannot be read becomes null."""
    return df.withColumns(
        {
            "age": F.col("age").try_cast("int"),
            "avg_balance_6m": F.col("avg_balance_6m").try_cast("double"),
            "clv_score": F.col("clv_score").try_cast("double"),
        }
    )


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    return df.fillna(dict(K.NULL_DEFAULTS if defaults is None else defaults))


def drop_unkeyed(df: DataFrame) -> DataFrame:
    return df.where(F.col("customer_id").isNotNull() & F.col("churn_label").isNotNull())


def stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def customer_order(columns: Sequence[str]) -> list[str]:
    """All columns but key and time, so that versions of equal time are ordered whatever the input order."""
    first = [c for c in ("age", "churn_label", "avg_balance_6m", "clv_score") if c in columns]
    return [*first, *sorted(c for c in columns if c not in (*first, "customer_id", "ingestion_ts"))]


def raw_to_silver(df: DataFrame) -> DataFrame:
    """Deduplicate, type, fill and filter.

    Rows without a key are dropped before the shuffle. The label filter stays behind the
    deduplication: a customer whose newest row has no label disappears.
    """
    tie_break = customer_order(df.columns)
    keyed = df.where(F.col("customer_id").isNotNull())
    latest = dedup_latest(keyed, "customer_id", "ingestion_ts", tie_break)
    return (
        latest.transform(enforce_types).transform(fill_defaults).transform(drop_unkeyed).transform(stamp, "silver_ts")
    )


def quality_counts(raw: DataFrame) -> DataFrame:
    """Rows read, kept and dropped, in one pass over the raw table.

    The newest version of a key is found by an aggregate; only the label of that version decides
    whether the customer is kept.
    """
    newest = raw.groupBy("customer_id").agg(
        F.count("*").alias("versions"),
        F.max(F.struct("ingestion_ts", *customer_order(raw.columns))).alias("newest"),
    )
    kept = F.col("customer_id").isNotNull() & F.col("newest.churn_label").isNotNull()
    return newest.agg(
        F.coalesce(F.sum("versions"), F.lit(0)).cast("bigint").alias("rows_in"),
        F.count_if(kept).alias("rows_kept"),
    ).select("rows_in", "rows_kept", (F.col("rows_in") - F.col("rows_kept")).alias("rows_dropped"))


# ------------------------------------------------------------------------------ request validation


def request_checks(segments: Sequence[str] = K.SEGMENT_DOMAIN) -> list[tuple[str, Column]]:
    """Violation columns of a scoring request: required values, ranges and the segment domain."""
    checks = [("customer_id", F.col("customer_id").isNull())]
    for name, low, high in K.REQUEST_RANGES:
        value = F.col(name)
        bad = value.isNull() | (value < low)
        checks.append((name, bad if high is None else bad | (value > high)))
    checks.append(("region", F.col("region").isNull()))
    checks.append(("segment", F.col("segment").isNull() | ~F.col("segment").isin(*segments)))
    return checks


def validate_rows(df: DataFrame, segments: Sequence[str] = K.SEGMENT_DOMAIN) -> DataFrame:
    """Adds ``violations`` (names of the failed checks) and ``is_valid``."""
    checked = df.withColumn("violations", failed_checks(request_checks(segments)))
    return checked.withColumn("is_valid", F.size("violations") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine of a validated frame."""
    return df.where("is_valid"), df.where("NOT is_valid")


def validation_summary(df: DataFrame) -> DataFrame:
    """Violations per check over a validated frame."""
    return (
        df.select(F.explode("violations").alias("check_name"))
        .groupBy("check_name")
        .agg(F.count("*").alias("n_violations"))
    )


def quality_expectations(df: DataFrame, key: str, segments: Sequence[str] = K.SEGMENT_DOMAIN) -> DataFrame:
    """Expectation table: every check with the number of failing rows and whether it holds.

    Null shares and checks come from one aggregate; uniqueness from a count per key.
    """
    names = [n for n, _ in request_checks(segments)]
    nullable = [c for c, _, _ in K.REQUEST_RANGES]
    totals = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(bad).alias(f"valid_{n}") for n, bad in request_checks(segments)],
        *[F.count_if(F.col(c).isNull()).alias(f"not_null_{c}") for c in nullable],
    )
    rows = [F.struct(F.lit(f"valid:{n}").alias("expectation"), F.col(f"valid_{n}").alias("n_failed")) for n in names]
    rows += [
        F.struct(F.lit(f"not_null:{c}").alias("expectation"), F.col(f"not_null_{c}").alias("n_failed"))
        for c in nullable
    ]
    checked = totals.select("n_rows", F.inline(F.array(*rows)))
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    unique = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.lit(f"unique:{key}").alias("expectation"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("n_failed"),
    )
    return checked.unionByName(unique).withColumn("holds", F.col("n_failed") == 0)
