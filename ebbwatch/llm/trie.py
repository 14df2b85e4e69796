"""Prefix trie of conversations, by collapsing whole sequences first.

A turn becomes two hashes that depend on its place, role and text; their running sums name the prefix that ends
there, 128 bits in all. Conversations with equal names as a whole are one sequence, with a weight and the list of
conversations that end there, so a conversation that occurs a million times is one row afterwards. Sequences that are
proper prefixes of others are found by an anti-join; the rest are leaves, and the prefixes of leaves are all nodes.

Sums over subtrees need no walk. Every node is owned by the smallest leaf below it; what a leaf owns is the lower end
of its path. The sum of a subtree is, over the leaves below its top, what each owns from the top's depth down: a running
sum along the path of each leaf, then one sum for each prefix. Rows stay in proportion to the turns of different
sequences, whatever the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.llm.mixing import count_words
from ebbwatch.sources.storage import materialize

PREFIX = ["depth", "p1", "p2"]  # names a node: the number of turns and two sums of their hashes
ENDS_CHUNK = 8_192  # conversations in a row of an end list


@dataclass(frozen=True)
class Trie:
    """``nodes``, ``sequences`` (depth, p1, p2, weight, conv_id, is_leaf) and ``ends`` (depth, p1, p2, from_id, conv_ids)."""

    nodes: DataFrame
    sequences: DataFrame
    ends: DataFrame


def read_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 0), role, text: turns in order, null first; equal turns are ordered by role, then text.

    Null roles and texts are empty. Rows without a conversation id belong to no conversation and are left out; a
    repeated row is a turn of its own.
    """
    named = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return named.withColumn("place", F.row_number().over(order) - 1).select("conv_id", "place", "role", "text")


def rebuild(turns: DataFrame, base: Column, shared: Column, most_shared: int) -> DataFrame:
    """``turns`` with a prefix taken from other conversations: the first ``shared`` turns of conversation ``base``, then
    a conversation's own after its first ``shared``.

    ``base`` and ``shared`` are expressions over conv_id, the second never over ``most_shared``. A conversation whose
    turns all go stays, as one row with a null place.
    """
    every = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", base.alias("base"), shared.alias("shared")
    )
    heads = turns.where(F.col("place") < most_shared).withColumnRenamed("conv_id", "head_of")
    taken = every.join(heads, (F.col("base") == F.col("head_of")) & (F.col("place") < F.col("shared")))
    # How many turns the base can give decides where a conversation's own go on.
    sizes = every.select(F.col("conv_id").alias("head_of"), F.col("n").alias("base_n"))
    given = every.join(sizes, F.col("base") == F.col("head_of"), "left").select(
        "conv_id", "n", "shared", F.least("shared", F.coalesce("base_n", F.lit(0))).alias("given")
    )
    own = turns.where("place >= 0").join(given.withColumnRenamed("conv_id", "own_of"), F.col("conv_id") == F.col("own_of"))
    own = own.where(F.col("place") >= F.col("shared")).select(
        "conv_id", (F.col("place") - F.col("shared") + F.col("given")).cast("int").alias("place"), "role", "text"
    )
    none = given.where((F.col("given") == 0) & (F.col("n") <= F.col("shared"))).select(
        "conv_id", F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")
    )
    return taken.select("conv_id", F.col("place").cast("int").alias("place"), "role", "text").union(own).union(none)


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2, words: one row for each prefix of each conversation, the empty one among them."""
    lane = lambda seed: F.xxhash64(F.lit(seed), "depth", "role", F.lit(seed + 1), "text").cast("decimal(20,0)")
    nothing = F.lit(0).cast("decimal(20,0)")
    rows = turns.where("place is not null").withColumn("depth", F.col("place") + 1)
    rows = rows.select("conv_id", "depth", lane(11).alias("h1"), lane(29).alias("h2"), count_words("text").alias("words"))
    roots = turns.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("depth"), nothing.alias("h1"), nothing.alias("h2"), F.lit(0).cast("bigint").alias("words")
    )
    path = Window.partitionBy("conv_id").orderBy("depth")
    upto = path.rowsBetween(Window.unboundedPreceding, 0)
    return rows.union(roots).select(
        "conv_id", "depth", F.sum("h1").over(upto).alias("p1"), F.sum("h2").over(upto).alias("p2"), "words",
        F.lead("depth").over(path).isNull().alias("is_end"),
    )


def build_trie(turns: DataFrame, ends_chunk: int = ENDS_CHUNK) -> Trie:
    """The trie of conversations given as rows (conv_id, place, role, text); a null place stands for no turns at all.

    ``nodes`` has one row for each different sequence of first turns, the empty one among them: depth, p1, p2 (its
    name), conv_id (the smallest conversation that starts with it), parent_conv_id (null at the root), words (of its
    last text), n_convs, n_children, n_leaves (childless nodes in its subtree, which includes its top) and saved_tokens
    (over its subtree, words times conversations beyond the first). ``sequences`` has one row for each different whole
    conversation, ``ends`` the conversations that end there, ascending, in rows of at most ``ends_chunk``.

    Each place of a conversation has one row. No conversations give no nodes. Intermediate tables are written.
    """
    prefixes = materialize(_prefixes(turns), "trie-prefixes")
    whole = prefixes.where("is_end")
    grouped = whole.groupBy(*PREFIX).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    grouped = materialize(grouped, "trie-sequences")
    # From here on one conversation stands for all that are equal to it.
    stands = grouped.select(F.col("conv_id").alias("stands"), "weight")
    paths = prefixes.join(stands, F.col("conv_id") == F.col("stands")).drop("stands")
    paths = materialize(paths, "trie-paths")
    proper = paths.where("not is_end").select(*PREFIX).distinct()
    leaves = grouped.join(proper, PREFIX, "left_anti").select(F.col("conv_id").alias("leaf"))
    sequences = grouped.join(leaves, F.col("conv_id") == F.col("leaf"), "left").select(
        *PREFIX, "weight", "conv_id", F.col("leaf").isNotNull().alias("is_leaf")
    )
    sequences = materialize(sequences, "trie-leaves")
    marked = paths.join(
        sequences.where("is_leaf").select(F.col("conv_id").alias("leaf")), F.col("conv_id") == F.col("leaf"), "left"
    ).select("conv_id", *PREFIX, "weight", "words", "leaf")
    marked = materialize(marked, "trie-marked")
    counted = marked.groupBy(*PREFIX).agg(
        F.sum("weight").alias("n_convs"),
        F.min("conv_id").alias("first_conv"),
        F.count("leaf").alias("n_leaves"),
        F.min("leaf").alias("owner"),
        F.first("words").alias("words_of"),
    )
    counted = materialize(counted, "trie-counts")  # a plain table, so that the join below can split the rows of a hot node
    saved = (F.col("n_convs") - 1) * F.col("words_of")
    joined = marked.where("leaf is not null").select("leaf", *PREFIX).join(counted, PREFIX)
    own = F.col("leaf") == F.col("owner")
    path = Window.partitionBy("leaf").orderBy("depth")
    placed = joined.select(
        "*",
        F.lag("first_conv").over(path).alias("parent_conv_id"),
        F.when(F.lead(own, 1, False).over(path), 1).otherwise(0).alias("own_child"),
        F.sum(F.when(own, saved).otherwise(0)).over(path.rowsBetween(0, Window.unboundedFollowing)).alias("own_saved"),
    )
    nodes = placed.groupBy(*PREFIX).agg(
        F.first("first_conv").alias("conv_id"),
        F.first("parent_conv_id").alias("parent_conv_id"),
        F.first("words_of").alias("words"),
        F.first("n_convs").cast("bigint").alias("n_convs"),
        F.sum("own_child").cast("bigint").alias("n_children"),
        F.first("n_leaves").alias("n_leaves"),
        F.sum("own_saved").cast("bigint").alias("saved_tokens"),
    )
    return Trie(nodes, sequences, _end_lists(whole, ends_chunk))


def _end_lists(whole: DataFrame, size: int) -> DataFrame:
    """depth, p1, p2, from_id, conv_ids: sorted conversations of each sequence, cut so that no row holds more than
    ``size``. Rows are dealt by range, so one sequence may lie in many tasks."""
    keys = [*PREFIX, "conv_id"]
    ordered = whole.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = np.zeros(batch.num_rows, bool)
            for name in PREFIX:
                encoded = batch.column(name).dictionary_encode().indices.to_numpy()
                cut[1:] |= encoded[1:] != encoded[:-1]
            starts = np.append(True, cut[1:])
            at = np.arange(batch.num_rows) - np.maximum.accumulate(np.where(starts, np.arange(batch.num_rows), 0))
            heads = np.flatnonzero(at % size == 0)
            bounds = np.append(heads, batch.num_rows).astype(np.int32)
            named = batch.select(PREFIX).take(pa.array(heads))
            ids = batch.column("conv_id")
            lists = pa.ListArray.from_arrays(bounds, ids)
            yield pa.RecordBatch.from_arrays([*named.columns, ids.take(pa.array(heads)), lists], [*PREFIX, "from_id", "conv_ids"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.select(*PREFIX).schema.fields)
    return ordered.mapInArrow(run, f"{kinds}, from_id long, conv_ids array<long>")


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, n_ends, ends_sha256 for end lists: the ids in order, comma-joined, through one running hash.

    The rows of a sequence pass through one task, one at a time: a hash has no parts that could be joined.
    """
    keys = [*PREFIX, "from_id"]
    text = F.array_join(F.transform("conv_ids", lambda i: i.cast("string")), ",")
    parts = ends.select(*keys, F.size("conv_ids").alias("n"), text.alias("text"))
    ordered = parts.repartition(*PREFIX).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, n = None, None, 0
        schema = None
        for batch in batches:
            done = []
            names = list(zip(*[batch.column(c).to_pylist() for c in PREFIX], strict=True))
            for name, size, part in zip(names, batch.column("n").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if name != now:
                    if now is not None:
                        done.append((*now, n, digest.hexdigest()))
                    now, digest, n = name, hashlib.sha256(part.encode()), size
                else:
                    digest.update(b"," + part.encode())
                    n += size
            schema = pa.schema([*[batch.schema.field(c) for c in PREFIX], ("n_ends", pa.int64()), ("ends_sha256", pa.string())])
            if done:
                yield _rows(done, schema)
        if now is not None:
            yield _rows([(*now, n, digest.hexdigest())], schema)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ends.select(*PREFIX).schema.fields)
    return ordered.mapInArrow(run, f"{kinds}, n_ends long, ends_sha256 string")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )
