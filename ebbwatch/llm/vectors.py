"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its closest pivots, nearest first. Two vectors are candidates when ``shared`` or more of
their ``nearest`` closest pivots are the same. Pivots are numbered from the rarest to the most frequent; a pair that
shares enough has its smallest shared pivot among the first ``nearest - shared + 1`` of both, so vectors are listed
under these alone, and a pair is counted in the list of its smallest shared pivot. There shared pivots are counted,
and pairs that reach the minimum are verified by their cosine in double precision.

Both numbers are settled by the data: vectors drawn by a hash are compared with all rows in blocks, and of the settings
that find enough of their links that with the fewest lists is taken.

Pivots are a sample thinned so that no two are nearly as close as a pair that links. A dense group has one pivot or
a few, not one for each share of its rows: among many the nearest would be noise, and members would share none.

Equal vectors are one entry. Lists longer than a block are divided in tiles of two blocks, so no task holds more;
what leaves a tile is one row for each vector with links: their number, and a link that spans its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.llm.common import in_runs
from ebbwatch.llm.components import connected, roots
from ebbwatch.sources.storage import materialize

MIN_PIVOTS, MAX_PIVOTS = 64, 8_192
SAMPLE = 4  # vectors drawn for each pivot, while they take less than SAMPLE_BYTES on the driver
SAMPLE_BYTES = 64_000_000
KNOWN = 24  # closest pivots kept with a vector
ASKED = 1_024  # vectors that measure the index; fewer where they would take more than SAMPLE_BYTES
ASKED_PAIRS = 64  # links of one of them that a batch of 2,048 vectors counts
ENOUGH = 0.995  # mean share of a measuring vector's links that the lists must hold
#: (nearest, shared) by the number of lists, and the one taken where too few links are known to measure by.
SETTINGS = sorted(((k, s) for k in (8, 12, 16, KNOWN) for s in range(2, k + 1)), key=lambda p: (p[0] - p[1], p[0]))
USUAL, FEW = (8, 2), 64


def usable(vector: str) -> F.Column:
    """Not null, not zero, all components finite."""
    values = F.col(vector)
    finite = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # keeps squares of huge or tiny values finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def thin(unit: np.ndarray, count: int, apart: float) -> np.ndarray:
    """The first ``count`` rows, in order, whose cosine with every row taken before is under ``apart``."""
    taken = np.zeros((min(count, len(unit)), unit.shape[1]))
    n = 0
    for at in range(0, len(unit), 256):
        part = unit[at : at + 256]
        free = (part @ taken[:n].T < apart).all(axis=1)
        inside = part @ part.T >= apart
        for i in range(len(part)):
            if free[i]:
                taken[n] = part[i]
                n += 1
                if n == len(taken):
                    return taken
                free &= ~inside[i]
    return taken[:n]


def _closest(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of the closest pivots, nearest first."""
    near = unit @ pivots.T
    k = min(KNOWN, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, axis=1), axis=1), axis=1).astype(np.int32)


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 2_048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _describe(entries: DataFrame, pivots: np.ndarray) -> DataFrame:
    """entries with ``near``, the numbers of the closest pivots, nearest first."""
    shared = entries.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            top = _closest(_unit(_matrix(part.column("vector"))), shared.value)
            yield pa.RecordBatch.from_arrays([*part.columns, _lists(top)], [*part.schema.names, "near"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema.fields)
    return entries.mapInArrow(run, f"{kinds}, near array<int>")


def _shared_of(a: np.ndarray, b: np.ndarray, settings: list[tuple[int, int]]) -> np.ndarray:
    """Whether rows of closest pivots share enough, by setting."""
    same = a[:, :, None] == b[:, None, :]
    counts = {k: same[:, :k, :k].sum(axis=(1, 2)) for k in {k for k, _ in settings}}
    return np.stack([counts[k] >= s for k, s in settings], axis=1)


def _measured(described: DataFrame, asked: pa.Table, pivots: np.ndarray, threshold: float) -> tuple[int, int]:
    """The (nearest, shared) with the fewest lists that hold ``ENOUGH`` of the links of the vectors asked for."""
    unit = _unit(_matrix(asked.column("vector").combine_chunks()))
    shared = described.sparkSession.sparkContext.broadcast((unit, asked.column("node").to_numpy(), _closest(unit, pivots)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, names, wanted = shared.value
        found = np.zeros((len(names), len(SETTINGS) + 1), np.int64)
        for part in _parts(batches):
            near = _matrix(part.column("near"))
            close = queries @ _unit(_matrix(part.column("vector"))).T >= threshold
            close &= names[:, None] != part.column("node").to_numpy()[None, :]
            for query in np.flatnonzero(close.any(axis=1)).tolist():
                rows = np.flatnonzero(close[query])[:ASKED_PAIRS]
                held = _shared_of(near[rows], wanted[query][None, :], SETTINGS)
                found[query] += np.append(held.sum(axis=0), len(rows))
        some = np.flatnonzero(found[:, -1])
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), _lists(found[some])], ["query", "found"])

    totals = described.mapInArrow(run, "query long, found array<long>").groupBy("query")
    columns = [F.sum(F.col("found")[i]).alias(f"f{i}") for i in range(len(SETTINGS) + 1)]
    rows = np.array([r[1:] for r in totals.agg(*columns).collect()], float)  # a row for each vector asked for, at most
    if len(rows) < FEW:
        return USUAL
    recall = (rows[:, :-1] / rows[:, -1:]).mean(axis=0)
    good = np.flatnonzero(recall >= ENOUGH)
    return SETTINGS[good[0] if len(good) else int(np.argmax(recall))]


def _frequencies(described: DataFrame, count: int, rank: np.ndarray, nearest: int, lists: int) -> np.ndarray:
    """How many vectors have each pivot, by its rank, among the first ``lists`` of their closest: one number a pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(count, np.int64)
        for batch in batches:
            if batch.num_rows:
                near = np.sort(rank[_matrix(batch.column("near"))[:, :nearest]], axis=1)[:, :lists]
                totals += np.bincount(near.ravel(), minlength=count)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["pivot", "rows"])

    out = np.zeros(count, np.int64)
    for r in described.select("near").mapInArrow(run, "pivot long, rows long").groupBy("pivot").agg(F.sum("rows")).collect():
        out[r[0]] = r[1]
    return out


def _deal(batches: Iterator[pa.RecordBatch], rank: np.ndarray, blocks: np.ndarray, nearest: int, lists: int) -> Iterator[pa.RecordBatch]:
    """A row for each tile that a vector belongs to: list, low and high block, its own block."""
    for part in _parts(batches, 256):
        if not part.num_rows:
            continue
        near = np.sort(rank[_matrix(part.column("near"))[:, :nearest]], axis=1).astype(np.int32)
        listed = near[:, :lists]
        times = blocks[listed]
        own = part.column("node").to_numpy()[:, None] % times
        row = np.repeat(np.arange(part.num_rows), times.sum(axis=1))
        ends = np.cumsum(times.ravel())
        other = np.arange(len(row)) - np.repeat(ends - times.ravel(), times.ravel())
        under, own = np.repeat(listed.ravel(), times.ravel()).astype(np.int64), np.repeat(own.ravel(), times.ravel())
        sorted_near = _lists(near)
        for at in range(0, len(row), 4_096):
            some = slice(at, at + 4_096)
            taken = part.take(pa.array(row[some]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(under[some]), pa.array(np.minimum(own, other)[some]), pa.array(np.maximum(own, other)[some]),
                    pa.array(own[some]), taken.column("node"), taken.column("weight"), taken.column("vector"),
                    sorted_near.take(pa.array(row[some])),
                ],
                ["list", "low", "high", "block", "node", "weight", "vector", "near"],
            )


def _tiles(batches: Iterator[pa.RecordBatch], threshold: float, minimum: int) -> Iterator[pa.RecordBatch]:
    """Links inside tiles, which come sorted by (list, low, high)."""
    for batch, ends in in_runs(batches, ("list", "low", "high")):
        start = 0
        while start < batch.num_rows:
            end = int(ends[start])
            if end - start > 1:
                key = tuple(batch.column(c)[start].as_py() for c in ("list", "low", "high"))
                yield from _tile(batch.slice(start, end - start), key, threshold, minimum)
            start = end


def _tile(rows: pa.RecordBatch, key: tuple[int, int, int], threshold: float, minimum: int) -> Iterator[pa.RecordBatch]:
    node, weight, block = (rows.column(c).to_numpy() for c in ("node", "weight", "block"))
    unit, near = _unit(_matrix(rows.column("vector"))), _matrix(rows.column("near"))
    left = np.flatnonzero(block == key[1])
    right = left if key[1] == key[2] else np.flatnonzero(block == key[2])
    links = np.zeros(len(node), np.int64)
    parent = np.arange(len(node))
    # A pair belongs here only if it shares no pivot below that of the list.
    lower = np.where(near < key[0], near, -1)
    # The most frequent of those pivots have bits; rows with one in common need no comparing.
    pivots, times = np.unique(lower[lower >= 0], return_counts=True)
    masks = np.zeros(len(node), np.uint64)
    for bit, pivot in enumerate(pivots[np.argsort(-times, kind="stable")[:64]].tolist()):
        masks[(lower == pivot).any(axis=1)] |= np.uint64(1 << 63 - bit)
    left = left[np.argsort(masks[left], kind="stable")]
    for at in range(0, len(left), 256):
        some = left[at : at + 256]
        other = right[masks[right] & np.bitwise_and.reduce(masks[some]) == 0]
        a, b = np.nonzero((unit[some] @ unit[other].T >= threshold) & (masks[some][:, None] & masks[other] == 0))
        a, b = some[a], other[b]
        if key[1] == key[2]:
            a, b = a[a < b], b[a < b]
        for cut in range(0, len(a), 65_536):
            x, y = a[cut : cut + 65_536], b[cut : cut + 65_536]
            shared = near[x][:, :, None] == near[y][:, None, :]
            apart = ~(shared & (lower[x] >= 0)[:, :, None]).any(axis=(1, 2))
            enough = apart & (shared.sum(axis=(1, 2)) >= minimum)
            x, y = x[enough], y[enough]
            parent = roots(len(node), x, y, parent)
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
    joined = (links > 0) | (parent != np.arange(len(node)))
    if joined.any():
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[joined]), pa.array(node[parent[joined]]), pa.array(links[joined])], ["a", "b", "links"]
        )


def link_vectors(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.95,
    setting: tuple[int, int] | None = None,
    block_rows: int = 4_096,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each vector.

    ``n_links`` counts the other vectors with a cosine of ``threshold`` or more that were found; ``component_id`` is
    the smallest id reachable over such links. Pairs that share too few of their closest pivots are not found:
    ``setting`` is (nearest, shared), by default the one with the fewest lists that holds 99.5 % of the links of 1,024
    vectors drawn by a hash and compared with all. Pivots are distinct vectors that come first by a hash, at most about
    the square root of the number of vectors, 64 to 8,192, and no two with a cosine of ``2 * threshold - 1`` or more;
    every vector is indexed. A block has ``block_rows`` vectors or 8 MB at most.

    Vectors that are null, zero, or hold null or non-finite components link with nothing and are kept. Vectors of
    different length are compared with none of the other lengths. Repeated rows link with each other; a null id is
    reported, kept only where no id of its component is known, and never a component's name otherwise. An empty
    table gives an empty result; other columns, labels among them, are not read.
    """
    named = embeddings.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("vector"))
    marked = named.withColumn("usable", usable("vector"))
    good = marked.where("usable").withColumn("node", F.xxhash64("vector"))
    entries = materialize(
        good.groupBy("vector").agg(F.first("node").alias("node"), F.count("*").alias("weight"), F.min("vec_id").alias("first_id")),
        "vectors",
    )
    found = None
    for row in entries.groupBy(F.size("vector").alias("size")).count().collect():
        part = entries.where(F.size("vector") == row["size"])
        count = min(MAX_PIVOTS, max(MIN_PIVOTS, 1 << math.ceil(math.log2(math.sqrt(row["count"])))))
        drawn = max(count, min(SAMPLE * count, SAMPLE_BYTES // (8 * row["size"])))
        sample = part.select("vector", "node").orderBy("node").limit(drawn).toArrow().column("vector").combine_chunks()
        pivots = thin(_unit(_matrix(sample)), count, 2 * threshold - 1)
        asked = part.select("vector", "node").orderBy(F.desc("node")).limit(min(ASKED, drawn)).toArrow()
        block = max(256, min(block_rows, (1 << 20) // row["size"])) if block_rows > 256 else block_rows
        links = _links_of(part, pivots, asked, threshold, setting, block)
        found = links if found is None else found.union(links)
    if found is None:
        found = entries.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("bigint").alias("links")).limit(0)
    found = materialize(found, "vector-links")
    groups = connected(found.select("a", "b"))
    totals = found.groupBy(F.col("a").alias("of")).agg(F.sum("links").alias("found_links"))
    labelled = entries.select("node", "weight", "first_id").join(groups.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_node = (
        labelled.join(smallest, "component")
        .join(totals, F.col("node") == F.col("of"), "left")
        .select(F.col("node").alias("of_node"), "component_id", (F.col("weight") - 1 + F.coalesce("found_links", F.lit(0))).alias("n_links"))
    )
    nodes = marked.select("vec_id", F.when(F.col("usable"), F.xxhash64("vector")).alias("node"))
    joined = nodes.join(per_node, F.col("node") == F.col("of_node"), "left")
    component = F.coalesce("component_id", F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _links_of(
    part: DataFrame, pivots: np.ndarray, asked: pa.Table, threshold: float, setting: tuple[int, int] | None, block_rows: int
) -> DataFrame:
    described = materialize(_describe(part.select("node", "weight", "vector"), pivots), "vector-pivots")
    count = len(pivots)
    nearest, shared = setting or _measured(described, asked, pivots, threshold)
    nearest = min(nearest, count)
    shared = min(shared, nearest)
    lists = nearest - shared + 1
    found = _frequencies(described, count, np.arange(count), nearest, nearest)
    rank = np.empty(count, np.int64)
    rank[np.argsort(found, kind="stable")] = np.arange(count)
    blocks = np.maximum(1, -(-_frequencies(described, count, rank, nearest, lists) // block_rows))
    dealt = described.mapInArrow(
        lambda batches: _deal(batches, rank, blocks, nearest, lists),
        f"list long, low long, high long, block long, node long, weight long, vector {part.schema['vector'].dataType.simpleString()}, near array<int>",
    )
    together = dealt.repartition("list", "low", "high").sortWithinPartitions("list", "low", "high")
    return together.mapInArrow(lambda batches: _tiles(batches, threshold, shared), "a long, b long, links long")
