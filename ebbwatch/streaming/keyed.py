"""A table of the newest row of each key, kept up to date by changes: the target of change logs and upsert sinks.

Rows are Parquet files in folders by bucket, the hash of the key. A write adds one part with the buckets it touches; a
manifest names the parts of every bucket. Buckets with too many parts are rewritten as one, the others stay as they
are, so reading costs a bounded number of files for each bucket however many batches came. The manifest is published
under the next number: readers see all of a change or nothing, and of two writers one is refused and tries again.

What a key looks like is decided by the order of its changes, not by the order of their arrival: batches may be
doubled, replayed or swapped. A deletion is a row that stays (a tombstone), or an older change that comes late would
bring the key back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.skew import heavy_join
from ebbwatch.sources import manifest
from ebbwatch.sources.storage import scratch_path
from ebbwatch.streaming.flows import kept_batch

BUCKET, DELETED = "_bucket", "_deleted"
_EMPTY = {"buckets": {}, "batches": {}}


@dataclass(frozen=True)
class KeyedTable:
    """``path`` is a folder that executors share; ``schema`` holds ``key`` and ``order``, the columns that order the
    changes of a key. Changes of equal order are told apart by their other columns, so any arrival gives one result.

    ``history`` is how many of the newest rows of a key stay, None for all of them. ``max_parts`` is how many parts a
    bucket has before it is rewritten.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    order: Sequence[str]
    buckets: int = 16
    history: int | None = 1
    max_parts: int = 8

    # ---------------------------------------------------------------------------------------- reading

    def version(self) -> int | None:
        return manifest.latest(self.spark, f"{self.path}/manifest")

    def _manifest(self, version: int | None) -> dict:
        return _EMPTY if version is None else manifest.read(self.spark, f"{self.path}/manifest", version)

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(DELETED, T.BooleanType())])

    def _scan(self, content: dict, buckets: Sequence[str]) -> DataFrame:
        """All stored rows of some buckets; the folders are named, so nothing else is listed or read."""
        stored = T.StructType([*self._stored().fields, T.StructField("part", T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        folders = [f"{self.path}/parts/part={p}/{BUCKET}={b}" for b in buckets for p in content["buckets"].get(b, [])]
        if not folders:
            return self.spark.createDataFrame([], self._stored())
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/parts").parquet(*folders)
        return rows.drop("part", BUCKET)

    def _newest(self, rows: DataFrame, count: int | None) -> DataFrame:
        """The ``count`` newest rows of each key, repeated rows once.

        One row is found by an aggregate, which leaves one row for each key and task before the shuffle.
        """
        others = [c for c in rows.columns if c not in (self.key, *self.order)]
        ordered = F.struct(*self.order, *others)
        if count == 1:
            newest = rows.groupBy(self.key).agg(F.max(ordered).alias("_row"))
            return newest.select(*[F.col(c) if c == self.key else F.col(f"_row.{c}").alias(c) for c in rows.columns])
        distinct = rows.distinct()
        if count is None:
            return distinct
        kept = distinct.groupBy(self.key).agg(F.slice(F.sort_array(F.collect_list(ordered), asc=False), 1, count).alias("_rows"))
        exploded = kept.select(self.key, F.explode("_rows").alias("_row"))
        return exploded.select(*[F.col(c) if c == self.key else F.col(f"_row.{c}").alias(c) for c in rows.columns])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows that are not deleted, as of a version or the latest one."""
        content = self._manifest(self.version() if version is None else version)
        rows = self._newest(self._scan(content, sorted(content["buckets"])), self.history)
        return rows.where(~F.col(DELETED)).select(*self.schema.names)

    def lookup(self, *keys) -> DataFrame:
        """The rows of a few keys; only the folders of their buckets are read."""
        content = self._manifest(self.version())
        kind = self.schema[self.key].dataType
        asked = self.spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("k", kind)]))
        at = {str(r[0]) for r in asked.select(self._bucket(F.col("k"))).collect()}  # a few literal keys
        rows = self._scan(content, sorted(at)).where(F.col(self.key).isin(*keys))
        return self._newest(rows, self.history).where(~F.col(DELETED)).select(*self.schema.names)

    def parts_per_bucket(self) -> dict[str, int]:
        return {b: len(p) for b, p in self._manifest(self.version())["buckets"].items()}

    # ---------------------------------------------------------------------------------------- writing

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Write rows as a part; returns its name and the buckets it has."""
        part = uuid.uuid4().hex
        folder = f"{self.path}/parts/part={part}"
        bucketed = rows.withColumn(BUCKET, self._bucket(F.col(self.key)))
        # The key goes along, so that a bucket is dealt over tasks and no task holds all of a large one.
        spread = bucketed.repartition(BUCKET, F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(4)))
        spread.sortWithinPartitions(BUCKET, self.key).write.partitionBy(BUCKET).option(
            f"parquet.bloom.filter.enabled#{self.key}", "true"
        ).parquet(folder)
        names = manifest.names_in(self.spark, folder)
        return part, [n.partition("=")[2] for n in names if n.startswith(f"{BUCKET}=")]

    def _commit(self, change: Callable[[dict], dict | None], tries: int = 20) -> bool:
        """Publish the next version from the latest one; False if ``change`` finds that there is nothing to do."""
        for _ in range(tries):
            now = self.version()
            content = change(self._manifest(now))
            if content is None:
                return False
            try:
                manifest.publish(self.spark, f"{self.path}/manifest", 0 if now is None else now + 1, content)
                return True
            except manifest.VersionTaken:
                continue
        raise manifest.VersionTaken(self.path)

    def apply(self, changes: DataFrame, writer: str | None = None, batch_id: int | None = None) -> bool:
        """Merge changes: rows of the schema, with a boolean ``_deleted`` where some are deletions.

        Rows without a key are left out. With ``writer`` and ``batch_id`` (which ascends) a batch that the table has
        already is skipped, and False returned.
        """
        seen = lambda content: writer is not None and content["batches"].get(writer, -1) >= batch_id
        if seen(self._manifest(self.version())):
            return False
        deleted = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in changes.columns else F.lit(False)
        keyed = changes.select(*self.schema.names, deleted.alias(DELETED)).where(F.col(self.key).isNotNull())
        part, touched = self._write(self._newest(keyed, self.history))

        def change(content: dict) -> dict | None:
            if seen(content):
                return None
            buckets = dict(content["buckets"])
            buckets.update({b: [*buckets.get(b, []), part] for b in touched})
            batches = content["batches"] if writer is None else {**content["batches"], writer: batch_id}
            return {"buckets": buckets, "batches": batches}

        done = self._commit(change)
        self.compact()
        return done

    def compact(self, max_parts: int | None = None) -> list[str]:
        """Rewrite the buckets with more parts than allowed as one part; returns these buckets.

        Tombstones stay. Parts that are added meanwhile stay beside the rewritten one; if another writer has
        rewritten a bucket first, its work counts.
        """
        content = self._manifest(self.version())
        limit = self.max_parts if max_parts is None else max_parts
        full = sorted(b for b, parts in content["buckets"].items() if len(parts) > limit)
        if not full:
            return []
        part, touched = self._write(self._newest(self._scan(content, full), self.history))

        def change(now: dict) -> dict | None:
            buckets = dict(now["buckets"])
            for b in touched:
                old = content["buckets"][b]
                if buckets[b][: len(old)] != old:
                    return None
                buckets[b] = [part, *buckets[b][len(old) :]]
            return {**now, "buckets": buckets}

        return full if self._commit(change) else []

    def vacuum(self, keep_versions: int = 10) -> int:
        """Delete parts and manifests that the last versions do not need; returns how many parts went.

        Not to be called while another writer is at work: what it has written and not published yet would go.
        """
        last = self.version()
        if last is None:
            return 0
        first = max(0, last - keep_versions + 1)
        needed = {p for v in range(first, last + 1) for ps in self._manifest(v)["buckets"].values() for p in ps}
        gone = [p for p in manifest.names_in(self.spark, f"{self.path}/parts") if p.removeprefix("part=") not in needed]
        for part in gone:
            manifest.delete(self.spark, f"{self.path}/parts/{part}")
        for name in manifest.names_in(self.spark, f"{self.path}/manifest"):
            if name.startswith("v") and int(name[1:13]) < first:
                manifest.delete(self.spark, f"{self.path}/manifest/{name}")
        return len(gone)


def apply_stream(changes: DataFrame, table: KeyedTable, label: str, transform: Callable[[DataFrame], DataFrame] = lambda batch: batch):
    """Apply what is available of a stream, batch by batch; replayed batches change nothing.

    A batch is kept while it is applied: each further use would run its stateful steps again. One without rows changes
    nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        with kept_batch(batch) as n:
            if n:
                table.apply(transform(batch), label, batch_id)

    started = (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", scratch_path(changes.sparkSession, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def as_of(rows: DataFrame, versions: DataFrame, key: str, at: str, since: str) -> DataFrame:
    """Every row with the version of its key that was valid at its time: the latest whose ``since`` is not later.

    The versions of a key come together first, so a row meets one row whatever their number; rows of busy keys are dealt
    over many tasks. Rows of unknown keys, and rows before the first version, have nulls.
    """
    values = [c for c in versions.columns if c not in (key, since)]
    present = rows.select(key).distinct()
    cut = versions.join(present, key, "left_semi")
    listed = cut.groupBy(key).agg(F.collect_list(F.struct(since, *values)).alias("_versions"))
    joined = heavy_join(rows, listed, [key], how="left")
    valid = F.array_max(F.filter("_versions", lambda v: v[since] <= F.col(at)))
    return joined.withColumn("_valid", valid).select(
        *rows.columns, F.col(f"_valid.{since}").alias(since), *[F.col(f"_valid.{c}").alias(c) for c in values]
    )
