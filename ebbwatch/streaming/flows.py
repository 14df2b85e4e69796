"""Streaming operators and the helpers that run them.

The functions take streaming or batch frames alike and return lazy frames; ``run_to_table`` and
``run_batches`` start a query, wait until the available input is processed and read the result.
Checkpoints and tables go to the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.quality import dedup_latest
from ebbwatch.operators.skew import heavy_join
from ebbwatch.schemas import EVENTS
from ebbwatch.sources.snapshot import customer_key
from ebbwatch.sources.storage import scratch_path

WATERMARK = "1 hour"


def utc_instant(clock: str) -> Column:
    """Wall-clock time read as UTC, whatever the session zone; watermarks need an instant."""
    return F.from_utc_timestamp(F.col(clock).cast("timestamp"), F.current_timezone())


def utc_clock(instant: Column | str) -> Column:
    """The UTC wall clock of an instant."""
    instant = F.col(instant) if isinstance(instant, str) else instant
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The event table of a folder as a stream, be it one file or a directory of files that grows.

    The name is written as a pattern, which lets Spark take a path that is a file.
    """
    return stream_table(spark, f"{folder}/event[s].parquet", EVENTS, files_per_trigger).withColumn("ts", utc_instant("ts"))


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream. Another source needs another format and options only."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def silver_events(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Typed events with a customer, each event once, late ones dropped by the watermark."""
    typed = events.where(F.col("event_id").isNotNull() & F.col("user_id").isNotNull()).select(
        "event_id",
        "ts",
        customer_key("user_id").alias("customer_id"),
        "event_type",
        F.col("value").try_cast("double").alias("value"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )
    return typed.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])


def score_events(batch: DataFrame, scores: DataFrame) -> DataFrame:
    """Every event with the current score and action of its customer (null for unknown customers).

    Micro-batches are planned without skew handling. The score table is first cut to the customers of the batch, whose
    list collapses before its shuffle; the events of busy customers are then dealt over many tasks.
    """
    present = batch.select("customer_id").distinct()
    return heavy_join(batch, scores.join(present, "customer_id", "left_semi"), ["customer_id"], how="left")


def activity_windows(events: DataFrame, kind: str, watermark: str = WATERMARK) -> DataFrame:
    """Events per window: ``tumbling`` and ``sliding`` by event type, ``session`` by customer."""
    on_time = events.withWatermark("ts", watermark)
    if kind == "session":
        window, who = F.session_window("ts", "30 minutes"), F.col("user_id").cast("string")
    elif kind == "tumbling":
        window, who = F.window("ts", "1 hour"), F.col("event_type")
    elif kind == "sliding":
        window, who = F.window("ts", "2 hours", "1 hour"), F.col("event_type")
    else:
        raise ValueError(f"kind must be 'tumbling', 'sliding' or 'session', not {kind!r}")
    counted = on_time.groupBy(window.alias("w"), who.alias("who")).agg(F.count("*").alias("n"))
    return counted.select(
        F.lit(kind).alias("kind"), "who", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n"
    )


# ------------------------------------------------------------------------------------ outcome of alerts


def alert_outcomes(events: DataFrame, alert: str, answer: str, within: str, watermark: str = WATERMARK) -> DataFrame:
    """One row for each alert event: when the same customer first answered it, and how often, within a time.

    A stream-stream interval join of alerts with later answers, both under watermarks, then an aggregate by alert. An
    alert leaves the state when the watermark has passed its time plus ``within``, answered or not; an answer leaves it
    when no open alert can be older. Events without a customer have no outcome; late ones are dropped.
    """
    typed = events.where(F.col("user_id").isNotNull() & F.col("event_id").isNotNull())
    alerts = typed.where(F.col("event_type") == alert).select(
        "event_id", customer_key("user_id").alias("customer_id"), F.col("ts").alias("alerted_at")
    )
    answers = typed.where(F.col("event_type") == answer).select(
        customer_key("user_id").alias("answered_by"), F.col("ts").alias("answered_at")
    )
    in_time = (F.col("answered_at") > F.col("alerted_at")) & (F.col("answered_at") <= F.col("alerted_at") + F.expr(f"INTERVAL {within}"))
    joined = alerts.withWatermark("alerted_at", watermark).join(
        answers.withWatermark("answered_at", watermark), (F.col("customer_id") == F.col("answered_by")) & in_time, "leftOuter"
    )
    told = joined.groupBy("event_id", "customer_id", "alerted_at").agg(
        F.min("answered_at").alias("answered_at"), F.count("answered_at").alias("n_answers")
    )
    return told.withColumn("answered", F.col("n_answers") > 0)


# ------------------------------------------------------------------------------------ customer state

STATE_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("user_id", "n_events", "n_errors", "n_purchases", "cents", "last_micros")]
)


def customer_state(events: DataFrame) -> DataFrame:
    """Running activity per customer, one row whenever new events arrive (output mode ``update``).

    The state is five numbers for each customer ever seen and is kept without end. Events are summed inside each
    input task first, so a busy customer is one row of it. A null or non-finite value counts no cents; events
    without a customer have a row of their own.
    """
    count_of = lambda kind: F.count_if(F.col("event_type") == kind)
    return events.groupBy("user_id").agg(
        F.count("*").alias("n_events"),
        count_of("error").alias("n_errors"),
        count_of("purchase").alias("n_purchases"),
        F.coalesce(F.sum(F.round(F.col("value") * 100).try_cast("bigint")), F.lit(0)).alias("cents"),
        F.max(F.unix_micros("ts")).alias("last_micros"),
    )


# ------------------------------------------------------------------------------------------- running


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """A session setting for the queries started inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Processes what is available into a Parquet table, exactly once, and reads the table.

    Session windows are merged inside each input task first, which keeps a busy key small.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    with session_setting(spark, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"):
        started = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{base}/table")
        )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


@contextmanager
def kept_batch(batch: DataFrame):
    """The number of rows of a micro-batch, which is kept inside the block: its stateful steps run once, in this count."""
    batch.persist()
    try:
        yield batch.count()
    finally:
        batch.unpersist()


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()):
    """``foreachBatch`` function: a batch owns one folder and rewrites it when it is replayed.

    A batch without rows, as the one that only closes the state, is written without being transformed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept_batch(batch) as n:
            told = transform(batch)
            rows = told if n else told.limit(0)
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")

    return write


def run_batches(
    stream: DataFrame,
    label: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    partition_by: Sequence[str] = (),
    mode: str = "append",
) -> DataFrame:
    """Processes what is available batch by batch; returns the stored rows with their ``batch_id``."""
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    started = (
        stream.writeStream.foreachBatch(batch_writer(f"{base}/table", transform, partition_by))
        .outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(stored).option("basePath", f"{base}/table").parquet(f"{base}/table")


def newest_versions(stored: DataFrame, key: str) -> DataFrame:
    """Upsert on read: the row of the latest batch for each key."""
    return dedup_latest(stored, key, "batch_id").drop("batch_id")
