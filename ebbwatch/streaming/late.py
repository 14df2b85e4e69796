"""Window counts that stay right when rows come late: a side output of the late rows, and corrections.

A window is published once the clock of the stream (the latest time seen, less a delay) has passed its end. Rows that
come for a published window are late: they are kept aside, and the window is corrected by a retraction of what was
published and a new count. Summing the log gives the counts of a batch over all rows, whenever they came.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.sources.storage import scratch_path
from ebbwatch.streaming.keyed import KeyedTable

_WINDOW = [
    T.StructField("window_id", T.StringType()),
    T.StructField("who", T.StringType()),
    T.StructField("start", T.TimestampType()),
    T.StructField("end", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
]
COUNTS = T.StructType([*_WINDOW, T.StructField("n", T.LongType())])
LOG = T.StructType([*_WINDOW, T.StructField("change", T.StringType()), T.StructField("n", T.LongType())])
CLOCK = T.StructType([T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("high", T.TimestampType())])


@dataclass(frozen=True)
class WindowLedger:
    """Counts of ``who`` in windows of one length. ``path`` is a folder that executors share.

    Every table is keyed by window (the clock by stream) and ordered by batch, and a batch writes what follows from
    the batches before it alone: a replayed batch changes nothing. Rows without a time or a ``who`` are left out.
    """

    spark: SparkSession
    path: str
    late_schema: T.StructType
    row_id: str
    who: str
    at: str = "ts"
    length: str = "1 hour"
    delay: str = "1 hour"
    buckets: int = 16

    def _table(self, name: str, schema: T.StructType, key: str, order: list[str], history: int | None = None) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.path}/{name}", schema, key, order, self.buckets, history)

    @property
    def counts(self) -> KeyedTable:
        return self._table("counts", COUNTS, "window_id", ["batch_id"])

    @property
    def log(self) -> KeyedTable:
        """Published counts: ``change`` is add or retract."""
        return self._table("log", LOG, "window_id", ["batch_id", "change"])

    @property
    def late(self) -> KeyedTable:
        """The rows that came after their window was published."""
        return self._table("late", self.late_schema, self.row_id, [self.at], history=1)

    @property
    def clock(self) -> KeyedTable:
        return self._table("clock", CLOCK, "stream", ["batch_id"])

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col(self.at).isNotNull() & F.col(self.who).isNotNull())
        windowed = rows.withColumn("_w", F.window(self.at, self.length)).withColumn("_who", F.col(self.who).cast("string"))
        before = self.clock.read().where(F.col("batch_id") < batch_id).agg(F.max("high")).first()[0]
        high = rows.agg(F.max(self.at)).first()[0]
        high = max((t for t in (before, high) if t is not None), default=None)
        if high is None:
            return
        then = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")  # null before the first batch
        now = F.lit(high).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")
        is_late = lambda end: F.coalesce(F.col(end) <= then, F.lit(False))

        grouped = windowed.groupBy(F.col("_who").alias("who"), F.col("_w.start").alias("start"), F.col("_w.end").alias("end")).agg(F.count("*").alias("n"))
        name = F.concat_ws("|", "who", F.unix_micros("start").cast("string")).alias("window_id")
        fresh = grouped.select(name, "who", "start", "end", F.lit(batch_id).cast("long").alias("batch_id"), "n")
        self.counts.apply(fresh, "ledger", batch_id)
        self.late.apply(windowed.where(is_late("_w.end")).select(*self.late_schema.names), "ledger", batch_id)

        # Only windows that this batch closes or corrects are summed; the range of their ends reaches the scan.
        known = self.counts.read().where(F.col("batch_id") <= batch_id)
        keys = ["window_id", "who", "start", "end"]
        closing = known.where((F.col("end") <= now) & ~is_late("end")).groupBy(*keys).agg(F.sum("n").alias("new"), F.lit(0).cast("long").alias("old"))
        late = known.where(is_late("end")).join(fresh.where(is_late("end")).select("window_id"), "window_id", "left_semi")
        corrected = late.groupBy(*keys).agg(
            F.sum("n").alias("new"), F.coalesce(F.sum(F.when(F.col("batch_id") < batch_id, F.col("n"))), F.lit(0)).alias("old")
        )
        both = closing.unionByName(corrected)
        changes = F.array(
            F.struct(F.lit("add").alias("change"), F.col("new").alias("n")), F.struct(F.lit("retract").alias("change"), F.col("old").alias("n"))
        )
        told = both.select(*keys, F.lit(batch_id).cast("long").alias("batch_id"), F.inline(changes)).where("n > 0")
        self.log.apply(told.select(*LOG.names), "ledger", batch_id)
        self.clock.apply(self.spark.createDataFrame([("events", batch_id, high)], CLOCK), "ledger", batch_id)

    def published(self) -> DataFrame:
        """who, start, end, n: what the log says now."""
        signed = F.when(F.col("change") == "add", F.col("n")).otherwise(-F.col("n"))
        return self.log.read().groupBy("who", "start", "end").agg(F.sum(signed).alias("n"))

    def run(self, stream: DataFrame, label: str) -> None:
        """Process what is available of a stream."""
        started = (
            stream.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", scratch_path(self.spark, f"{label}-checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
