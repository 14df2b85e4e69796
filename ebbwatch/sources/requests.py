"""JSON scoring requests as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.schemas import BATCH_REQUEST, SCORING_REQUEST


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per request body; unreadable JSON gives null fields and ``is_readable`` false."""
    parsed = df.withColumn("_r", F.from_json(body, SCORING_REQUEST, {"mode": "PERMISSIVE"}))
    kept = [c for c in df.columns if c != body]
    fields = [F.col(f"_r.{f}").alias(f) for f in SCORING_REQUEST.fieldNames()]
    return parsed.select(*kept, F.col("_r.customer_id").isNotNull().alias("is_readable"), *fields)


def parse_batch_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per customer of each batch body (``{"customers": [...]}``)."""
    kept = [c for c in df.columns if c != body]
    exploded = df.select(
        *kept,
        F.posexplode_outer(F.from_json(body, BATCH_REQUEST, {"mode": "PERMISSIVE"})["customers"]).alias("item", "_r"),
    )
    fields = [F.col(f"_r.{f}").alias(f) for f in SCORING_REQUEST.fieldNames()]
    return exploded.select(*kept, "item", *fields)


def event_properties(events: DataFrame) -> DataFrame:
    """Typed property of each event's JSON body."""
    return events.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )
