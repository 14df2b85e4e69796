"""Periodic runs of words, from maximal pairs of the LCP-interval tree of each document.

A run with period q is a stretch whose words equal those q places later, that no neighbouring word extends. Its
first place s and s + q are a maximal pair: the words from both agree up to the end of the run, the words before
them differ. Maximal pairs are found bottom-up: the intervals of a suffix array with its LCP values are merged from
the longest common prefix down, each holding its occurrences in text order with the class of their left words. A pair
belongs to the interval that joins its two occurrences, whose LCP value is its length, if their left classes differ.

Only pairs at a distance of at most their length divided by (exponent - 1) are runs. Within such a distance the
common prefix overlaps itself, so its next occurrence is exactly one period on: neighbours in text order that a merge
brings together are all pairs that matter, and no pair has to be extended. A distance of several periods gives the
same stretch again; the smallest one stays.

Intervals below the shortest possible pair, those with a single left class and those whose occurrences lie too far
apart hold no run and are left out before the tree is walked, by array operations over a shard of documents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.llm.common import add_by_shard, utf8

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType()),
]
_RUN_ARROW = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Limits:
    """What makes a stretch a run: at least ``min_length`` words and ``exponent`` periods."""

    def __init__(self, min_length: int, exponent: int):
        if min_length < 2 or exponent < 2:
            raise ValueError("a run has two words and two periods at least")
        self.min_length, self.exponent = min_length, exponent
        #: No pair is shorter than this.
        self.shortest = min(int(self.pair_length(q)) for q in range(1, min_length + 1))

    def pair_length(self, period):
        """Least common length of the pair of places that a run with this period starts."""
        return np.maximum(self.min_length, self.exponent * period) - period


def _suspects(ids: np.ndarray, ends: np.ndarray, limits: Limits) -> np.ndarray:
    """Documents in which some words of the shortest pair's length come twice, near enough and after different words.

    Word groups are compared by hashes: equal ones always meet, and what else meets is sorted out later.
    """
    n, size = limits.shortest, np.diff(ends, prepend=0)
    at = np.arange(len(ids))
    doc = np.repeat(np.arange(len(ends)), size)
    fits = at + n <= ends[doc]
    at = at[fits]
    key = doc[at].astype(np.uint64)
    for k in range(n):
        key = (key ^ ids[at + k].astype(np.uint64)) * _MIX
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")  # places of equal groups stay in text order
    at, key = at[order], key[order]
    if not len(at):
        return np.zeros(0, np.int64)
    same = key[1:] == key[:-1]
    gap, owner = np.diff(at), doc[at[1:]]
    near = same & (owner == doc[at[:-1]]) & (gap * limits.exponent <= size[owner])
    # Only neighbours with different left words, or at a document's start, tell a group with more than one class.
    begin = ends - size
    left = np.where(at == begin[doc[at]], -1 - at, ids[at - 1])
    number = np.cumsum(np.append(True, ~same)) - 1
    near_group = np.zeros(number[-1] + 1, bool)
    near_group[number[1:][near]] = True
    mixed = np.zeros(number[-1] + 1, bool)
    mixed[number[1:][same & (left[1:] != left[:-1])]] = True
    return np.unique(doc[at[(near_group & mixed)[number]]])


def _ranks(ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Names of the groups of 1, 2, 4, ... words from each place, in the order of the suffixes, until none tie.

    Documents do not compare with each other. A place's document number leads its first name, and each document is
    followed by a word of its own.
    """
    size = np.diff(ends, prepend=0) + 1
    doc = np.repeat(np.arange(len(ends)), size)
    words = np.full(len(ids) + len(ends), -1, np.int64)
    inside = np.ones(len(words), bool)
    inside[np.cumsum(size) - 1] = False
    words[inside] = ids
    _, rank = np.unique((doc.astype(np.int64) << 32) | (words + 1), return_inverse=True)
    count = np.bincount(rank)
    first = np.cumsum(count) - count
    tied = np.flatnonzero(count[rank] > 1)
    rank = first[rank].astype(np.int32)
    levels, h = [rank], 1
    while len(tied):
        key = (rank[tied].astype(np.int64) << 32) | rank[tied + h]
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        length = np.diff(first, append=len(key))
        group = key >> 32
        outer = np.flatnonzero(np.diff(group, prepend=-1))
        inner = np.repeat(first, length) - np.repeat(outer, np.diff(outer, append=len(key)))
        rank = rank.copy()
        rank[tied] = group + inner
        levels.append(rank)
        tied = tied[np.repeat(length > 1, length)]
        h *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels) - 1)):
        step = np.where(levels[k][a] == levels[k][b], 1 << k, 0)
        a, b, total = a + step, b + step, total + step
    return total


def _walk(places: list[int], lcp: list[int], left: list[int], limits: Limits) -> list[tuple[int, int, int]]:
    """Maximal pairs (place, later place, length) of one block of a suffix array, merged from the longest LCP down."""
    held = [[p] for p in places]  # occurrences of an interval, in text order, at its first row
    class_of = dict(zip(places, left, strict=True))
    single: list[int | None] = list(left)  # the left class of an interval, None for several
    last = list(range(len(places)))  # at the first row of an interval its last, at the last its first
    first = list(range(len(places)))
    found = []
    for at in sorted(range(len(lcp)), key=lcp.__getitem__, reverse=True):
        length, x, y = lcp[at], first[at], at + 1
        small, large = sorted((held[x], held[y]), key=len)
        one = single[x] is not None and single[x] == single[y]
        if not one:
            for p in small:
                c, k = class_of[p], bisect_left(large, p)
                for q in large[max(0, k - 1) : k + 1]:
                    gap = abs(p - q)
                    if class_of[q] != c and max(limits.min_length, limits.exponent * gap) - gap <= length:
                        found.append((min(p, q), max(p, q), length))
        if 8 * len(small) < len(large):
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        end = last[y]
        held[x], single[x] = large, single[x] if one else None
        last[x], first[end] = end, x
    return found


def runs_of(ids: np.ndarray, ends: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and (start, length, period) of all runs of documents of word numbers, sorted."""
    none = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    some = _suspects(ids, ends, limits) if len(ids) else none[0]
    if not len(some):
        return none
    size = np.diff(ends, prepend=0)[some]
    stops = np.cumsum(size)
    part = ids[np.repeat(ends[some] - stops, size) + np.arange(stops[-1])]
    levels = _ranks(part, stops)
    begin = stops - size + np.arange(len(some))  # with one word of its own after each document
    doc = np.repeat(np.arange(len(some)), size + 1)
    order = np.empty(len(doc), np.int64)
    order[levels[-1]] = np.arange(len(doc))
    lcp = _common(levels, order[:-1], order[1:])
    deep = lcp >= limits.shortest
    edges = np.flatnonzero(np.diff(deep.astype(np.int8), prepend=0, append=0))
    first, after = edges[0::2], edges[1::2] + 1  # rows of the blocks of the suffix array
    if not len(first):
        return none
    rows = np.repeat(first - (np.cumsum(after - first) - (after - first)), after - first) + np.arange((after - first).sum())
    block = np.repeat(np.arange(len(first)), after - first)
    place = order[rows]
    padded = np.concatenate([[0], np.full(len(doc), -1)])
    padded[1 + np.arange(len(part)) + np.repeat(np.arange(len(some)), size)] = part
    left = np.where(place == begin[doc[place]], -1 - place, padded[place])
    head = np.cumsum(after - first) - (after - first)
    mixed = np.bitwise_or.reduceat(left != left[head[block]], head)
    in_text = np.lexsort((place, block))
    gap = np.diff(place[in_text], append=0)
    gap[np.append(head[1:] - 1, len(gap) - 1)] = np.iinfo(np.int64).max // 64
    nearest = np.minimum.reduceat(gap, head)
    longest = np.maximum.reduceat(np.append(lcp, 0)[rows] * np.append(np.diff(block) == 0, False), head)
    kept = np.flatnonzero(mixed & (limits.pair_length(nearest) <= longest))
    pairs: list[tuple[int, int, int]] = []
    for b in kept.tolist():
        cut = slice(head[b], head[b] + after[b] - first[b])
        pairs += _walk(place[cut].tolist(), lcp[first[b] : after[b] - 1].tolist(), left[cut].tolist(), limits)
    if not pairs:
        return none
    a, b, length = np.array(pairs, np.int64).T
    table = np.stack([doc[a], a - begin[doc[a]], length + b - a, b - a], axis=1)
    table = table[np.lexsort(table.T[::-1])]
    table = table[np.append(True, np.any(table[1:, :3] != table[:-1, :3], axis=1))]  # the smallest period of a stretch
    table = table[np.lexsort((table[:, 3], table[:, 1], table[:, 0]))]
    return some[table[:, 0]], table[:, 1:]


def find_runs(
    documents: DataFrame, text: str = "text", min_length: int = 6, exponent: int = 4, shard_bytes: int = 4_000_000
) -> DataFrame:
    """``documents`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of at least ``min_length``
    words and ``exponent`` of its smallest periods that no neighbouring word extends. ``collapsed`` holds the words
    that no run contains after its first period, joined by single spaces.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Repeated rows are searched each; ids play
    no part. Input columns named like a result are replaced. An empty table gives an empty result. Nothing is
    shuffled: a shard of documents is searched inside its task, and a text longer than a shard is a shard alone.
    """
    limits = Limits(min_length, exponent)

    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        words = [(t or b"").split() for t in utf8(shard.column(text))]
        counts = np.array([len(w) for w in words], np.int64)
        vocabulary = dict.fromkeys(chain.from_iterable(words))
        vocabulary = dict(zip(vocabulary, range(len(vocabulary)), strict=True))
        ids = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(words)), np.int64, counts.sum())
        owner, found = runs_of(ids, np.cumsum(counts), limits)
        joined = [b" ".join(w) for w in words]
        for d in np.unique(owner).tolist():
            kept = np.ones(counts[d], bool)
            for start, length, period in found[owner == d].tolist():
                kept[start + period : start + length] = False
            joined[d] = b" ".join([words[d][i] for i in np.flatnonzero(kept).tolist()])
        offsets = np.searchsorted(owner, np.arange(len(words) + 1)).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in found.T], fields=list(_RUN_ARROW))
        return [
            pa.array(counts),
            pa.ListArray.from_arrays(offsets, structs),
            pa.array(joined, pa.binary()).cast(pa.string()),
        ]

    return add_by_shard(documents, text, FIELDS, compute, shard_bytes)


def longest_run(runs: str = "runs") -> F.Column:
    """The run with the greatest length; of equal ones the first to start, then that with the smallest period."""
    keyed = F.transform(
        runs, lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("less"), r.alias("run"))
    )
    return F.array_max(keyed)["run"]
