"""Benchmark decontamination: an FM-index over each shard of the training text, searched backwards.

A shard is a bounded run of documents inside one Spark partition. Its text becomes a sequence of word
symbols; words that no benchmark phrase holds can lie in no occurrence and act as separators, and runs
between separators that are shorter than the shortest phrase are left out of the index. The index is a
suffix array (kept sampled), the Burrows-Wheeler transform in a wavelet matrix, and symbol counts.
Phrases are searched from their last word by rank queries, occurrences are located by walking to the
next sampled position, and the spans found are merged per document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.llm.common import LOWER, add_by_shard, utf8, words_of

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(SPAN)),
]
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Bits:
    """A bit vector with rank: packed words and the counts before them."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        w, low = i >> 6, (i & 63).astype(np.uint64)
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << low) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        for level in reversed(range(max(1, int(sigma - 1).bit_length()))):
            bit = (symbols >> level) & 1
            self.levels.append((level, Bits(bit.astype(bool)), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.start = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, i) - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for level, bits, zeros in self.levels:
            bit, ones = bits.get(i).astype(np.int64), bits.rank(i)
            symbol |= bit << level
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i - self.start[symbol]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence that ends in 0; each 0 is a separator, smaller than what follows it.

    Prefix doubling on the suffixes that still tie; no tie crosses a separator.
    """
    n = len(symbols)
    apart = symbols == 0
    rank = np.where(apart, np.cumsum(apart) - 1, symbols.astype(np.int64) + int(apart.sum()) - 1)
    order = np.argsort(rank, kind="stable")
    first = np.flatnonzero(np.diff(rank[order], prepend=-1))
    rank[order] = np.repeat(first, np.diff(first, append=n))
    tied = order[np.repeat(np.diff(first, append=n) > 1, np.diff(first, append=n))]
    h = 1
    while len(tied):
        key = (rank[tied] << 32) | rank[tied + h]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        size = np.diff(first, append=len(key))
        group = key >> 32
        outer = np.flatnonzero(np.diff(group, prepend=-1))
        inside = np.repeat(first, size) - np.repeat(outer, np.diff(outer, append=len(key)))
        rank[tied] = group + inside
        tied = tied[np.repeat(size > 1, size)]
        h *= 2
    order[rank] = np.arange(n)
    return order


class FMIndex:
    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = 16):
        """``symbols`` ends in 0; 0 separates runs and is never searched for."""
        n = len(symbols)
        order = suffix_array(symbols)
        last = symbols[order - 1].astype(np.int64)
        self.n = n
        self.before = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=sigma), out=self.before[1:])
        self.bwt = WaveletMatrix(last, sigma)
        marked = (order % sample == 0) | (last == 0)  # a walk never leaves its run
        self.marks = Bits(marked)
        self.samples = order[marked]

    def search(self, reversed_phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each phrase; rows hold the words from the last, then -1."""
        low = np.zeros(len(reversed_phrases), np.int64)
        high = np.full(len(reversed_phrases), self.n, np.int64)
        for step in range(reversed_phrases.shape[1]):
            symbol = reversed_phrases[:, step]
            live = np.flatnonzero((symbol >= 0) & (low < high))
            if not len(live):
                break
            c = symbol[live]
            low[live] = self.before[c] + self.bwt.rank(c, low[live])
            high[live] = self.before[c] + self.bwt.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to the next sampled position."""
        found = np.empty(len(rows), np.int64)
        left, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            done = self.marks.get(rows).astype(bool)
            found[left[done]] = self.samples[self.marks.rank(rows[done])] + steps
            left, rows = left[~done], rows[~done]
            symbol, rank = self.bwt.access(rows)
            rows = self.before[symbol] + rank
            steps += 1
        return found


class Phrases:
    """Word windows of benchmark items, ready for the search.

    What travels is the words of the items as numbers; windows are cut from them when a shard is searched, and only
    those whose words all occur in the shard are looked up.
    """

    CHUNK = 100_000  # windows that are cut at once

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocab: dict[bytes, int] = {}
        parts = [np.zeros(0, np.int32)]
        self.names: list[str | None] = []
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            if ids:
                parts.append(np.array(ids, np.int32))
                self.names.append(item)
        sizes = np.array([len(x) for x in parts[1:]], np.int64)
        self.words, self.window = np.concatenate(parts), window
        self.first = np.cumsum(sizes) - sizes  # of each item
        self.length = np.minimum(sizes, window)  # of its windows
        self.windows = np.cumsum(sizes - self.length + 1)  # up to each item

    def cut(self, present: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Items and reversed words (then -1) of windows, some at a time, whose words are all present."""
        total = int(self.windows[-1]) if len(self.windows) else 0
        for at in range(0, total, self.CHUNK):
            number = np.arange(at, min(total, at + self.CHUNK))
            item = np.searchsorted(self.windows, number, side="right")
            length = self.length[item]
            since = number - np.where(item > 0, self.windows[item - 1], 0)
            back = length[:, None] - 1 - np.arange(self.window)
            rows = np.where(back >= 0, self.words[(self.first[item] + since)[:, None] + np.maximum(back, 0)], -1)
            kept = ((rows < 0) | present[rows]).all(axis=1)
            yield item[kept], rows[kept]

    def find(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[set[str]], dict[int, np.ndarray]]:
        """Word counts, items and covered words (as flags, for documents with a hit) of one shard."""
        get, none = self.vocab.get, repeat(0)
        ids = [np.fromiter(map(get, w := words_of(t or b""), none), np.int32, len(w)) for t in texts]
        counts = np.array([len(x) for x in ids], np.int64)
        items: list[set[str]] = [set() for _ in texts]
        if not len(self.length) or not counts.sum():
            return counts, items, {}
        end = np.zeros(1, np.int32)
        symbols = np.concatenate([x for one in ids for x in (one, end)])
        known = np.diff((symbols != 0).astype(np.int8), prepend=0, append=0)
        starts, stops = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
        long = stops - starts >= self.length.min()
        starts, sizes = starts[long], (stops - starts)[long] + 1
        if not len(starts):
            return counts, items, {}
        offset = np.cumsum(sizes) - sizes
        place = np.repeat(starts - offset, sizes) + np.arange(sizes.sum())
        index = FMIndex(symbols[place], len(self.vocab) + 1)
        present = np.zeros(len(self.vocab) + 1, bool)
        present[symbols[place]] = True
        first = np.cumsum(counts + 1) - counts - 1
        cover = np.zeros(len(symbols) + 1, np.int32)
        hit_docs = []
        for item, phrases in self.cut(present):
            low, high = index.search(phrases)
            size = high - low
            rows = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
            owner = np.repeat(item, size)
            where = place[index.locate(rows)]
            np.add.at(cover, where, 1)
            np.add.at(cover, where + self.length[owner], -1)
            doc = np.searchsorted(first, where, side="right") - 1
            for pair in np.unique(doc * len(self.names) + owner).tolist():
                d, name = pair // len(self.names), self.names[pair % len(self.names)]
                hit_docs.append(d)
                if name is not None:
                    items[d].add(name)
        covered = np.cumsum(cover[:-1]) > 0
        flags = {d: covered[first[d] : first[d] + counts[d]] for d in set(hit_docs)}
        return counts, items, flags


def spans_of(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return [
        {"start": a, "end": b}
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
    ]


def cut_words(text: bytes, spans: list[dict[str, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    words = [m.span() for m in _WORD.finditer(text.translate(LOWER))]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : words[span["start"]][0]])
        at = words[span["end"] - 1][1]
    return b"".join([*kept, text[at:]])


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shard_bytes: int = 8_000_000,
    block_bytes: int = 16_000_000,
) -> DataFrame:
    """``documents`` with ``n_words``, ``items`` (distinct item ids as strings) and ``spans`` (merged word spans).

    A window is ``window`` consecutive words of an item, or all words of a shorter item. The benchmark is
    searched in blocks of about ``block_bytes`` of its text, each sent to the executors as the numbers of its words
    and searched in a pass of its own over the shards, without a shuffle. A single item is not divided.

    Null and empty texts have no words and no hits. Items without words match nothing; an item with a null id
    marks words but is not listed. Repeated rows are reported each. Input columns named like a result are
    replaced. Empty tables give empty results, or documents without hits.
    """
    found = documents.drop(*[f.name for f in FIELDS])
    for block, phrases in enumerate(_blocks(benchmark, item_id, item_text, window, block_bytes)):
        found = _search(found, text, phrases, shard_bytes, merge=block > 0)
    return found


def remove_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shard_bytes: int = 8_000_000,
    block_bytes: int = 16_000_000,
) -> DataFrame:
    """``documents`` without the words of the spans that ``find_contamination`` finds, and ``words_removed``.

    Documents of which no word is left are dropped; the others stay, those without hits as they are, null and empty
    texts among them. The last block is searched and cut in one pass. Input columns named like a result of either
    function are replaced or dropped; options and other cases as in ``find_contamination``.
    """
    found = documents.drop(*[f.name for f in FIELDS], "words_removed")
    *before, last = _blocks(benchmark, item_id, item_text, window, block_bytes)
    for block, phrases in enumerate(before):
        found = _search(found, text, phrases, shard_bytes, merge=block > 0)
    names = [f.name for f in found.schema.fields if f.name not in {f.name for f in FIELDS}]

    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        texts = utf8(shard.column(text))
        counts, _, flags = _merged(last.value, shard, text, bool(before))
        cut = [cut_words(t, spans_of(flags[d])) if d in flags else t for d, t in enumerate(texts)]
        gone = np.array([int(flags[d].sum()) if d in flags else 0 for d in range(len(texts))], np.int64)
        return [pa.array(cut, pa.binary()).cast(pa.string()), pa.array(gone), pa.array(counts - gone)]

    fields = [T.StructField(text, T.StringType()), T.StructField("words_removed", T.LongType()), T.StructField("_left", T.LongType())]
    cut = add_by_shard(found, text, fields, compute, shard_bytes)
    return cut.where("words_removed = 0 or _left > 0").select(*[F.col(f"`{n}`") for n in names], "words_removed")


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, window: int, block_bytes: int) -> list:
    """Broadcasts of the phrases, one for about ``block_bytes`` of the benchmark's text each; at least one."""
    bench = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text")
    ).where("text is not null")
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    parts = [bench] if blocks == 1 else [bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) for b in range(blocks)]
    send = benchmark.sparkSession.sparkContext.broadcast
    return [send(Phrases([(r.item, r.text.encode()) for r in part.distinct().collect()], window)) for part in parts]


def _merged(phrases: Phrases, shard: pa.RecordBatch, text: str, merge: bool) -> tuple[np.ndarray, list[set[str]], dict]:
    """What a shard holds of some phrases, with what it is known to hold of earlier ones."""
    counts, items, flags = phrases.find(utf8(shard.column(text)))
    if merge:
        known = zip(shard.column("items").to_pylist(), shard.column("spans").to_pylist(), strict=True)
        for d, (ids, spans) in enumerate(known):
            items[d].update(ids)
            for span in spans:
                flags.setdefault(d, np.zeros(counts[d], bool))[span["start"] : span["end"]] = True
    return counts, items, flags


def _search(documents: DataFrame, text: str, phrases, shard_bytes: int, merge: bool) -> DataFrame:
    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        counts, items, flags = _merged(phrases.value, shard, text, merge)
        spans = [spans_of(flags[d]) if d in flags else [] for d in range(len(counts))]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return [
            pa.array(counts),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            pa.array(spans, kind),
        ]

    return add_by_shard(documents, text, FIELDS, compute, shard_bytes)


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
