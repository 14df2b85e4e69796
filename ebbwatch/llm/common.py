"""What the corpus operators share: byte-level words, bounded shards of Arrow batches, column passing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Most rows of an Arrow batch between Spark and Python; whole texts make rows long, and each task holds some batches.
BATCH_ROWS = 1_000
ROW_BYTES = 64  # what a row counts besides its text, so that empty texts fill a shard too

UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(UPPER, UPPER.lower())
#: A-Z lowered; everything but 0-9, a-z and non-ASCII bytes becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD_REGEX = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text: maximal runs of digits, letters and non-ASCII characters."""
    return text.translate(WORD_BYTES).split()


def utf8(column: pa.Array) -> list[bytes | None]:
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def in_shards(batches: Iterator[pa.RecordBatch], text: str, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition, in order, in batches of about ``shard_bytes`` of text; a longer text is a shard alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + ROW_BYTES)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = min(batch.num_rows, int(np.searchsorted(ends, before + shard_bytes - size)) + 1)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= shard_bytes:
                yield _one(held)
                held, size = [], 0
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def add_by_shard(
    df: DataFrame,
    text: str,
    fields: Sequence[T.StructField],
    compute: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    shard_bytes: int,
) -> DataFrame:
    """Append columns computed shard by shard in Python; no shuffle, one shard in memory at a time.

    Input columns that bear the name of a result are replaced by it.
    """
    small_batches(df.sparkSession)
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    schema = T.StructType([*kept, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in in_shards(batches, text, shard_bytes):
            arrays = [shard.column(shard.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *compute(shard)], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows of an Arrow batch to ``BATCH_ROWS``, unless they are fewer already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def in_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole runs of equal integer keys, from rows sorted by them, and where each run ends, by row.

    A run that goes over several batches comes in one; runs of a batch come together.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero(np.any(values[:, 1:] != values[:, :-1], axis=0)) + 1
        if held and tuple(values[:, 0]) != last:
            yield _with_ends(held, keys)
            held = []
        if held and len(cuts):
            held.append(batch.slice(0, cuts[0]))
            yield _with_ends(held, keys)
            held, batch, cuts = [], batch.slice(cuts[0]), cuts[1:] - cuts[0]
        if not held and len(cuts):
            yield _with_ends([batch.slice(0, cuts[-1])], keys)
            batch = batch.slice(cuts[-1])
        held.append(batch)
        last = tuple(values[:, -1])
    if held:
        yield _with_ends(held, keys)


def _with_ends(batches: list[pa.RecordBatch], keys: Sequence[str]) -> tuple[pa.RecordBatch, np.ndarray]:
    batch = _one(batches)
    values = np.stack([batch.column(k).to_numpy() for k in keys])
    cuts = np.flatnonzero(np.any(values[:, 1:] != values[:, :-1], axis=0)) + 1
    ends = np.append(cuts, batch.num_rows)
    return batch, np.repeat(ends, np.diff(ends, prepend=0))
