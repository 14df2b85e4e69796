"""Change log of customers applied to a keyed table, and versioned scores that running streams look up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.quality import customer_order
from ebbwatch.schemas import ALERTS, CUSTOMER_RAW
from ebbwatch.streaming.flows import utc_clock
from ebbwatch.streaming.keyed import DELETED, KeyedTable, as_of

#: A change: the customer's row as it is from ``ingestion_ts`` on, and what happened to it.
CUSTOMER_CHANGE = T.StructType([*CUSTOMER_RAW.fields, T.StructField("op", T.StringType())])
SCORES = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("churn_risk_level", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
    ]
)


def customer_table(spark: SparkSession, path: str, buckets: int = 16, max_parts: int = 8) -> KeyedTable:
    """The newest row of each customer; equal times are ordered as the deduplication of the batch does."""
    order = ["ingestion_ts", *customer_order(CUSTOMER_RAW.names)]
    return KeyedTable(spark, path, CUSTOMER_RAW, "customer_id", order, buckets, max_parts=max_parts)


def customer_changes(feed: DataFrame) -> DataFrame:
    """Insertions and updates replace a customer's row, deletions end it; an unknown operation is an update."""
    return feed.select(*CUSTOMER_RAW.names, (F.coalesce(F.col("op"), F.lit("")) == "delete").alias(DELETED))


def score_board(spark: SparkSession, path: str, buckets: int = 16, versions: int | None = None) -> KeyedTable:
    """Scores of each customer by the time from which they hold; ``versions`` bounds how many are kept."""
    return KeyedTable(spark, path, SCORES, "customer_id", ["valid_from"], buckets, history=versions)


def publish_scores(board: KeyedTable, scores: DataFrame, valid_from) -> None:
    """Make scores valid from a time on; streams that run see them from their next batch."""
    since = F.lit(valid_from).cast("timestamp").alias("valid_from")
    board.apply(scores.select("customer_id", since, *[n for n in SCORES.names if n not in ("customer_id", "valid_from")]))


def score_events_as_of(batch: DataFrame, board: KeyedTable, at: str = "ts") -> DataFrame:
    """Every event with the scores of its customer that held at its time, from what is published now."""
    return as_of(batch, board.read(), "customer_id", at, "valid_from").drop("valid_from")


def alert_table(spark: SparkSession, path: str, buckets: int = 16, max_parts: int = 8) -> KeyedTable:
    """The alert of each event by the latest score it was rated with."""
    schema = T.StructType([*ALERTS.fields, T.StructField("valid_from", T.TimestampType())])
    return KeyedTable(spark, path, schema, "event_id", ["valid_from"], buckets, max_parts=max_parts)


def alerts_of(batch: DataFrame, board: KeyedTable, levels: tuple[str, ...] = ("ALTO", "MEDIO")) -> DataFrame:
    """Alerts for the events of customers that were at risk then. An event that is rated anew and no longer at risk
    ends its alert."""
    rated = as_of(batch, board.read(), "customer_id", "ts", "valid_from").where("valid_from is not null")
    day = F.date_format(utc_clock("ts"), "yyyy-MM-dd")
    calm = ~F.col("churn_risk_level").isin(*levels)
    return rated.select(*ALERTS.names[:4], day.alias("day"), "valid_from", calm.alias(DELETED))


PROFILE = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("n_products", T.IntegerType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("churn_risk_level", T.StringType()),
        T.StructField("vip_classification", T.StringType()),
        T.StructField("as_of", T.TimestampNTZType()),
    ]
)


def profile_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """The newest scored profile of each customer, for lookups by key."""
    return KeyedTable(spark, path, PROFILE, "customer_id", ["as_of"], buckets)
