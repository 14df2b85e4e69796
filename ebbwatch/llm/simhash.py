"""SimHash near-duplicates through an inverted index on the bytes of the fingerprints.

Fingerprints within 3 bits of each other differ in at most 3 of their 8 bytes, so they share at least 5 bytes in
place. The index lists fingerprints under several bytes in place; where two meet, their shared bytes are tallied,
pairs that reach the minimum are kept, and the bits are compared.

For 64 bits the lists are under four bytes. The 14 sets of four positions whose numbers sum to zero under exclusive or
hold every three positions in exactly one set, so a pair meets in the list of the other four bytes: none is lost. The
fingerprints of a list differ in 32 bits at most. Lists under single bytes would hold a 256th of all fingerprints
each, and their pairs grow with the square of the corpus.

Exact copies are one entry of the index, and lists send on links that span their components, not all pairs. A list
longer than ``BLOCK`` is divided in tiles of two blocks, so that no task holds more of it. In a long list the
fingerprints close to a middle one are linked first; the others alone are compared with all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.llm.common import LOWER, add_by_shard, in_runs, utf8
from ebbwatch.llm.components import connected, roots
from ebbwatch.sources.storage import materialize

SEED = 42
BYTES = 8
MIN_SHARED = 5
#: Differing bytes of a pair lie in one of these sets; its list is under the other four bytes.
APART = [s for s in combinations(range(BYTES), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
KEYS = [tuple(b for b in range(BYTES) if b not in s) for s in APART]
DIRECT = 1 << 15  # a list this long is searched by flipping bits instead of comparing all with all
BLOCK = 1 << 18  # fingerprints of a list that stay together; longer lists are tiled
SAMPLED = 16  # one in so many fingerprints tells which lists are long; that changes the work, not the result
MIDDLES = 4  # rounds of linking a long list's fingerprints to a middle one
SMALL = 256  # runs up to this length are compared together, longer ones each alone
_BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :] & 1).astype(np.int64)

Accept = Callable[[np.ndarray, np.ndarray], np.ndarray]


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of all word shingles, repeats included; fewer words are one shingle, no words none."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = zip(*[words[i:] for i in range(shingle)], strict=False) if len(words) > shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.array([digest(join(p), SEED) for p in parts], np.uint64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Each bit set in more than half of the rows of (n, words) hashes; 0 for no rows."""
    n, words = hashes.shape
    lanes = 8 * words
    place = np.arange(lanes, dtype=np.int32) * 256
    tally = np.zeros(lanes * 256, np.int64)
    for at in range(0, n, 4096):
        some = np.ascontiguousarray(hashes[at : at + 4096])
        tally += np.bincount((some.view(np.uint8) + place).ravel(), minlength=lanes * 256)
    ones = tally.reshape(lanes, 256) @ _BITS
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").reshape(-1).view("<u8")


def fingerprint(text: bytes, shingle: int = 3) -> int:
    return int(majority(shingle_hashes(text, shingle)[:, None])[0])


def _add_words(documents: DataFrame, text: str, names: list[str], compute_one, shard_bytes: int = 2_000_000) -> DataFrame:
    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        rows = np.array([compute_one(t or b"") for t in utf8(shard.column(text))], np.uint64)
        return [pa.array(column) for column in np.ascontiguousarray(rows.reshape(-1, len(names)).T).view(np.int64)]

    return add_by_shard(documents, text, [T.StructField(n, T.LongType()) for n in names], compute, shard_bytes)


def as_hex(fingerprint: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _shared_bytes(mixed: np.ndarray) -> np.ndarray:
    """How many bytes in place are equal, from the exclusive or of two fingerprints."""
    return (mixed.view(np.uint8).reshape(*mixed.shape[:-1], 8 * mixed.shape[-1]) == 0).sum(axis=-1)


def accept_close(bits: int) -> Accept:
    def accept(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = a ^ b
        kept = _shared_bytes(mixed) >= MIN_SHARED
        kept[kept] = np.bitwise_count(mixed[kept]).sum(axis=-1) <= bits
        return kept

    return accept


def _link_to_middles(prints: np.ndarray, accept: Accept) -> tuple[np.ndarray, np.ndarray]:
    """Links to fingerprints in the middle of the others: parents, and the rows outside the largest component."""
    n = len(prints)
    parent, rest = np.arange(n), np.arange(n)
    for _ in range(MIDDLES):
        some = prints[rest]
        middle = rest[np.argmin(np.bitwise_count(some ^ majority(some)).sum(axis=1))]
        hit = np.flatnonzero(accept(prints, prints[middle]))
        parent = roots(n, hit, np.full(len(hit), middle), parent)
        rest = np.flatnonzero(parent != np.argmax(np.bincount(parent)))
        if not len(rest):
            break
    return parent, rest


def forest(prints: np.ndarray, accept: Accept, flips: int | None = None) -> np.ndarray:
    """For each different fingerprint of a long list, the row of its component's first.

    ``flips`` tells that a link is a difference of so many bits, which a very long list of single words uses.
    """
    n, words = prints.shape
    parent, rest = _link_to_middles(prints, accept)
    if flips and words == 1 and n >= DIRECT:
        flat = prints[:, 0]
        order = np.argsort(flat)
        ordered = flat[order]
        free = [i for i in range(64) if np.any((flat ^ flat[0]) >> np.uint64(i) & np.uint64(1))]
        for k in range(1, flips + 1):
            for some in combinations(free, k):
                other = flat[rest] ^ np.uint64(sum(1 << f for f in some))
                at = np.minimum(np.searchsorted(ordered, other), n - 1)
                hit = np.flatnonzero(ordered[at] == other)
                parent = roots(n, rest[hit], order[at[hit]], parent)
        return parent
    outside = np.zeros(n, bool)
    outside[rest] = True
    line = np.concatenate([rest, np.flatnonzero(~outside)])
    step = max(1, 1_000_000 // (n * words))
    for at in range(0, len(rest), step):
        a, b = np.nonzero(accept(prints[line[at : min(at + step, len(rest))], None], prints[None, line[at:]]))
        parent = roots(n, line[a + at], line[b + at], parent)
    return parent


def _links(batches: Iterator[pa.RecordBatch], names: list[str], accept: Accept, flips: int | None) -> Iterator[pa.RecordBatch]:
    """Links that span the components of lists, which come sorted by (list, key)."""
    for batch, ends in in_runs(batches, ("list", "key")):
        node = batch.column("node").to_numpy()
        prints = np.ascontiguousarray(np.stack([batch.column(n).to_numpy() for n in names], axis=1)).view(np.uint64)
        rows = np.arange(len(node))
        starts = np.concatenate([[0], ends[:-1][np.diff(ends) > 0]]) if len(ends) else rows
        sizes = np.diff(np.append(starts, len(node)))
        small = np.repeat(sizes, sizes) <= SMALL
        distinct, number = np.unique(node, return_inverse=True)
        parent = np.arange(len(distinct))
        left, step = rows[small], 1
        while len(left := left[left + step < ends[left]]):
            for at in range(0, len(left), 200_000):
                a = left[at : at + 200_000]
                near = a[accept(prints[a], prints[a + step])]
                parent = roots(len(distinct), number[near], number[near + step], parent)
            step += 1
        for run in np.flatnonzero(sizes > SMALL).tolist():
            span = slice(starts[run], starts[run] + sizes[run])
            root = forest(prints[span], accept, flips)
            parent = roots(len(distinct), number[span], number[span][root], parent)
        far = parent != np.arange(len(distinct))
        if far.any():
            yield pa.RecordBatch.from_arrays([pa.array(distinct[far]), pa.array(distinct[parent[far]])], ["a", "b"])


def _meet(indexed: DataFrame, names: list[str], accept: Accept, flips: int | None = None) -> DataFrame:
    """(a, b): links between the rows of each list of (list, key, node, words)."""
    together = indexed.repartition("list", "key").sortWithinPartitions("list", "key")
    return together.mapInArrow(lambda batches: _links(batches, names, accept, flips), "a long, b long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def link_fingerprints(prints: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b): links between different fingerprints that connect what ``bits`` differing bits connect.

    ``prints`` has the column ``fingerprint`` without repeats.
    """
    if not 0 <= bits <= BYTES - MIN_SHARED:
        raise ValueError("at most 3 differing bits are guaranteed to share 5 bytes")
    masks = [_signed(sum(0xFF << 8 * b for b in key)) for key in KEYS]
    lists = F.array(
        *[
            F.struct(F.lit(i).alias("list"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("key"))
            for i, mask in enumerate(masks)
        ]
    )
    indexed = prints.select(F.col("fingerprint").alias("node"), F.explode(lists).alias("at")).select(
        "at.list", "at.key", "node", F.col("node").alias("w0")
    )
    return _meet(_in_tiles(indexed), ["w0"], accept_close(bits), bits)


def _in_tiles(indexed: DataFrame) -> DataFrame:
    """Rows of long lists once for each other block of their list; a list's number then tells the tile as well."""
    some = indexed.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(SAMPLED)) == 0)
    counted = some.groupBy("list", "key").agg((F.count("*") * SAMPLED).alias("rows")).where(F.col("rows") > BLOCK)
    long = materialize(counted.select("list", "key", F.ceil(F.col("rows") / BLOCK).alias("blocks")), "simhash-lists")
    marked = indexed.join(long, ["list", "key"], "left").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda x: x != F.col("own"))
    dealt = marked.withColumn(
        "other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(others))
    )
    tile = (1 + F.least("own", "other") * (1 << 24) + F.greatest("own", "other")) * len(KEYS)
    return dealt.select((F.col("list") + F.coalesce(tile, F.lit(0))).alias("list"), "key", "node", "w0")


def _name_groups(entries: DataFrame, links: DataFrame) -> DataFrame:
    """node, component_id (smallest first_id) for entries of (node, first_id)."""
    groups = connected(links).select(F.col("node").alias("member"), "component")
    labelled = entries.join(groups, F.col("node") == F.col("member"), "left").select(
        "node", F.coalesce("component", "node").alias("component"), "first_id"
    )
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return labelled.join(smallest, "component").select("node", "component_id")


def group_near_copies(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3, shingle: int = 3
) -> DataFrame:
    """doc_id, fingerprint (signed) and component_id, the smallest id reachable over links, for each document.

    Null and empty texts have fingerprint 0 and are linked like any other. A null id stays in the result; it
    counts only where a component has no other id. Repeated rows are reported each. An empty table gives an empty
    result; other columns are not read.
    """
    named = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    printed = _add_words(named, "text", ["fingerprint"], lambda t: fingerprint(t, shingle))
    marked = materialize(printed.select("doc_id", "fingerprint"), "simhash")
    first = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    links = link_fingerprints(first.select("fingerprint"), bits)
    named_groups = _name_groups(first.withColumnRenamed("fingerprint", "node"), links)
    return marked.join(named_groups, F.col("fingerprint") == F.col("node"), "left").select(
        "doc_id", "fingerprint", "component_id"
    )


def keep_one_of_each(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3, shingle: int = 3
) -> DataFrame:
    """One document of each group of ``group_near_copies``, that with the smallest id, with all its columns.

    Null and empty texts are copies of each other. A null id stays only where its group has no other; of rows with
    the id that stays but other texts, one stays, chosen by a hash of the text, and of repeated rows one. An empty
    table gives an empty one; columns may bear any names.
    """
    id_, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    keys = [F.xxhash64(F.lit(n), id_, body).alias(f"_row{n}") for n in (1, 2)]  # 128 bits name a row
    named = documents.select(id_.alias("doc_id"), body.alias("text"), *keys)
    printed = _add_words(named, "text", ["fingerprint"], lambda t: fingerprint(t, shingle))
    marked = materialize(printed.select("doc_id", "_row1", "_row2", "fingerprint"), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row1", "_row2")
    first = marked.groupBy("fingerprint").agg(F.min(order).alias("first"))
    groups = connected(link_fingerprints(first.select("fingerprint"), bits))
    labelled = first.join(groups, F.col("fingerprint") == F.col("node"), "left")
    chosen = labelled.groupBy(F.coalesce("component", "fingerprint")).agg(F.min("first").alias("first"))
    chosen = chosen.select(F.col("first._row1").alias("_kept1"), F.col("first._row2").alias("_kept2"))
    known = documents.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(documents.columns)], *keys)
    one = known.join(chosen, (F.col("_row1") == F.col("_kept1")) & (F.col("_row2") == F.col("_kept2")), "left_semi")
    one = one.dropDuplicates(["_row1", "_row2"])
    return one.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(documents.columns)])
