"""Best-fit packing of documents into sequences of fixed capacity, planned on the histogram of lengths.

Every document becomes pieces of at most ``capacity`` ids. How many pieces have each length is a histogram of at most
``capacity`` rows, whatever the corpus. Best fit decreasing runs over its counts: sequences of like content are one
group, and a length takes the groups with the least sufficient room first, as many of its pieces into each sequence as
fit. The plan says, for each length and rank, in which sequence and where the piece goes. Pieces know their rank within
length from their shard and from how many the shards before hold, and take their slots by a join with the plan.

The plan is bounded: a length opens three groups at most, and lengths that differ fill a sequence after some
sqrt(2 * capacity) of them. Ids are moved once, to the task that joins the pieces of their sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import in_runs, in_shards, small_batches
from ebbwatch.llm.tokens import encoder
from ebbwatch.sources.storage import scratch_path

CAPACITY = 1024
SLOTS = "length int, rank_from long, rank_to long, times long, first_sequence long, at long"
#: Shards up to this number have what stands before them broadcast: capacity * 8 bytes each.
BROADCAST_SHARDS = 4_000


def plan_slots(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of SLOTS for a histogram of lengths: best fit decreasing over the counts.

    Ranks rank_from <= r < rank_to of a length go, ``times`` to a sequence, into the sequences from
    ``first_sequence`` on, from place ``at`` of each. An empty histogram has no slots.
    """
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths are between 1 and the capacity")
    rooms: list[int] = []  # sorted, without repeats
    groups: dict[int, list[tuple[tuple, int]]] = {}  # room left: (what the sequences hold, how many sequences)

    def put(room: int, held: tuple, n: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((held, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                held, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            else:
                room, held, n = capacity, (), -(-left // (capacity // length))
            times = room // length
            whole = min(n, left // times)
            if whole:
                put(room - times * length, (*held, (length, times)), whole)
            left -= whole * times
            if whole < n and left > 0:  # fewer than ``times`` are left for one more sequence
                put(room - left * length, (*held, (length, left)), 1)
                whole, left = whole + 1, 0
            if whole < n:
                put(room, held, n - whole)
    slots, rank, sequence = [], dict.fromkeys(counts, 0), 0
    for room in rooms:
        for held, n in groups[room]:
            at = 0
            for length, times in held:
                slots.append((length, rank[length], rank[length] + n * times, times, sequence, at))
                rank[length] += n * times
                at += length * times
            sequence += n
    return slots


def cut_pieces(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, start and length of the pieces of documents with so many ids; the first may be shorter."""
    pieces = -(-sizes // capacity)
    row = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = sizes - capacity * (pieces - 1)
    start = np.where(number > 0, first[row] + capacity * (number - 1), 0)
    return row, number, start, np.where(number > 0, capacity, first[row])


def encode_pieces(
    documents: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    capacity: int = CAPACITY,
    shard_bytes: int = 4_000_000,
) -> DataFrame:
    """Written table of pieces: doc_id, piece, start, length, shard, rank (within shard and length), ids (bytes).

    A document is the ids of its whole text, then ``end_id``. Null texts are empty: the end id alone. Repeated rows
    and null ids are documents like any other. An empty table has no pieces; other columns are not read.
    """
    small_batches(documents.sparkSession)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        end, known = np.array([end_id], enc.kind), np.zeros(capacity + 1, np.int64)
        for batch in in_shards(batches, "text", shard_bytes):
            parts = [part for ids in enc.encode(batch.column("text")) for part in (ids, end)]
            sizes = np.array([len(x) for x in parts], np.int64).reshape(-1, 2).sum(axis=1)
            stream = np.concatenate(parts).astype(enc.kind.newbyteorder("<"), copy=False)
            row, number, start, length = cut_pieces(sizes, capacity)
            order = np.argsort(length, kind="stable")
            count = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(count) - count, count)
            rank += known[length]
            known += count
            ends = np.concatenate([[0], np.cumsum(length)]) * stream.itemsize
            for at in range(0, len(row), 8_192):
                cut = slice(at, at + 8_192)
                part = stream.view(np.uint8)[ends[at] : ends[min(at + 8_192, len(row))]]
                offsets = (ends[at : at + 8_193] - ends[at]).astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row[cut])),
                        pa.array(number[cut].astype(np.int32)),
                        pa.array(start[cut]),
                        pa.array(length[cut].astype(np.int32)),
                        pa.array(np.full(len(row[cut]), shard, np.int32)),
                        pa.array(rank[cut]),
                        data,
                    ],
                    ["doc_id", "piece", "start", "length", "shard", "rank", "ids"],
                )
            pa.default_memory_pool().release_unused()

    schema = f"doc_id {kind}, piece int, start long, length int, shard int, rank long, ids binary"
    path = scratch_path(documents.sparkSession, "pieces")
    made = rows.mapInArrow(run, schema)
    made.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(made.schema).parquet(path)


def take_slots(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` instead of shard and rank."""
    spark = pieces.sparkSession
    counted = pieces.groupBy("shard", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    slots = spark.createDataFrame(plan_slots(histogram, capacity), SLOTS)
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("shard", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # One row for each shard, with a number for each length.
    entries = F.map_from_entries(F.collect_list(F.struct("length", "before")))
    per_shard = before.groupBy("shard").agg(entries.alias("known")).select(
        F.col("shard").alias("of_shard"),
        F.transform(F.sequence(F.lit(1), F.lit(capacity)), lambda i: F.coalesce(F.try_element_at("known", i), F.lit(0))).alias("before"),
    )
    if pieces.select("shard").distinct().count() <= BROADCAST_SHARDS:
        per_shard = F.broadcast(per_shard)
    ranked = pieces.join(per_shard, F.col("shard") == F.col("of_shard")).select(
        "doc_id", "piece", "start", F.col("length").alias("size"), "ids",
        (F.col("rank") + F.element_at("before", F.col("length"))).alias("rank"),
    )
    fits = (F.col("size") == F.col("length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    since = F.col("rank") - F.col("rank_from")
    return ranked.join(F.broadcast(slots), fits).select(  # bounded by the capacity, see above
        "doc_id", "piece", "start", F.col("size").alias("length"),
        (F.col("first_sequence") + F.floor(since / F.col("times"))).alias("sequence_id"),
        (F.col("at") + F.pmod(since, F.col("times")) * F.col("size")).alias("offset"),
        "ids",
    )


_PLACES = "array<struct<doc_id: {}, piece: int, start: bigint, length: int, offset: bigint>>"


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    capacity: int = CAPACITY,
    shard_bytes: int = 4_000_000,
) -> DataFrame:
    """sequence_id, ids (bytes, two or four little-endian to an id), pieces: one row for each packed sequence.

    ``pieces`` lists what the sequence holds, without gaps from its first id: doc_id, piece, start (ids of the
    document before it), length, offset. Sequences are numbered from 0. Only documents of more than ``capacity`` ids
    are cut. Null, empty, repeated and missing rows as in ``encode_pieces``.
    """
    pieces = encode_pieces(documents, tokenizer, doc_id, text, end_id, capacity, shard_bytes)
    placed = take_slots(pieces, capacity)
    together = placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    names = ["doc_id", "piece", "start", "length", "offset"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ends in in_runs(batches, ("sequence_id",)):
            bounds = np.concatenate([[0], np.unique(ends)])
            ids = batch.column("ids")
            data = np.frombuffer(ids.buffers()[2], np.uint8) if ids.buffers()[2] else np.zeros(0, np.uint8)
            offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1][bounds]
            joined = pa.Array.from_buffers(
                pa.binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data)]
            )
            held = pa.StructArray.from_arrays([batch.column(n) for n in names], names)
            lists = pa.ListArray.from_arrays(bounds.astype(np.int32), held)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id").take(pa.array(bounds[:-1])), joined, lists], ["sequence_id", "ids", "pieces"]
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    return together.mapInArrow(join, f"sequence_id bigint, ids binary, pieces {_PLACES.format(kind)}")


def read_pieces(sequences: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece, from packed sequences.

    No sequences give no pieces; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            held = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            offset, length = held.field("offset").to_numpy(), held.field("length").to_numpy()
            filled = np.zeros(batch.num_rows, np.int64)
            np.add.at(filled, row, length)
            ids = [
                np.frombuffer(x, f"<u{len(x) // n}").astype("<u4")
                for x, n in zip(batch.column("ids").to_pylist(), filled.tolist(), strict=True)
            ]
            crc = [
                zlib.crc32(ids[r][a : a + n].tobytes())
                for r, a, n in zip(row.tolist(), offset.tolist(), length.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *[held.field(n) for n in ("doc_id", "piece", "start")],
                    held.field("length").cast(pa.int64()),
                    pa.array(crc, pa.int64()),
                    batch.column("sequence_id").take(pa.array(row)),
                    held.field("offset"),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = sequences.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()
    return sequences.mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
