"""Prefix tries, packed sequences and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbwatch.llm import packing, periods, trie
from ebbwatch.llm.queries import tokenizer_path, with_periods

SPACE = re.compile(r"[^\x20\x09-\x0D]+")

# ------------------------------------------------------------------------------------------- tries


def brute_nodes(conversations):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends) of each prefix."""
    members, kids = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
        words = len(SPACE.findall(k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in kids.get(k, []))
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(conversations[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), len(kids.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes_of(built):
    digests = trie.end_digests(built.ends)
    rows = built.nodes.join(digests, trie.PREFIX, "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return [
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or empty)
        for r in rows
    ]


def in_order(nodes):
    return sorted(nodes, key=lambda n: (n[0], n[1], str(n)))


@pytest.mark.parametrize("chunk", [3, 8_192])
def test_trie_equals_brute_force(spark, chunk):
    rng = random.Random(4)
    rows = []
    for c in [*range(70), 12345678901]:
        for t in range(rng.choice([0, 1, 2, 3, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "c", " ", None, "", "a  b"])))
    rows += [(900 + i, t, "user", "the same words") for i in range(40) for t in range(4)]
    rows += [(0, None, "system", "first"), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (None, 0, "user", "nobody")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS place", "2 AS depth", "3 AS p1", "'x' AS words", "4 AS weight"
    )
    given = {}
    for r in rows:
        if r[0] is not None:
            given.setdefault(r[0], []).append(r)
    own = {
        c: [(r[2] or "", r[3] or "") for r in sorted(x, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        for c, x in given.items()
    }
    shared = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    want = {c: own.get(c - c % 20, [])[: shared[c]] + x[shared[c] :] for c, x in own.items()}
    assert any(not x for x in want.values())
    turns = trie.read_turns(df)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    rebuilt = trie.rebuild(turns, F.col("conv_id") - F.col("conv_id") % 20, h, 3)
    built = trie.build_trie(rebuilt, ends_chunk=chunk)
    assert in_order(nodes_of(built)) == in_order(brute_nodes(want))
    same = {}
    for c, x in want.items():
        same.setdefault(tuple(x), []).append(c)
    sequences = sorted((r.conv_id, r.depth, r.weight) for r in built.sequences.collect())
    assert sequences == sorted((min(m), len(k), len(m)) for k, m in same.items())
    lists = built.ends.collect()
    assert max(len(r.conv_ids) for r in lists) <= chunk
    joined = {}
    for r in sorted(lists, key=lambda r: r.from_id):
        joined.setdefault((r.depth, r.p1, r.p2), []).extend(r.conv_ids)
    assert sorted(joined.values()) == sorted(sorted(m) for m in same.values())


def test_trie_of_one_long_conversation_and_of_none(spark):
    long = spark.range(400).selectExpr("7L conv_id", "id turn", "'user' role", "concat('w', id) text")
    rows = nodes_of(trie.build_trie(trie.read_turns(long)))
    assert in_order(rows) == in_order(brute_nodes({7: [("user", f"w{i}") for i in range(400)]}))
    none = trie.build_trie(trie.read_turns(long.limit(0)))
    assert none.nodes.count() == none.sequences.count() == none.ends.count() == 0


# ----------------------------------------------------------------------------------------- packing


def best_fit(lengths, capacity):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect_left(rooms, length)
        room = rooms.pop(i) if i < len(rooms) else capacity
        n += room == capacity
        insort(rooms, room - length)
    return n


def test_plan_equals_best_fit_of_single_pieces():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([5, 16, 100, 1024])
        counts = {rng.randint(1, capacity): rng.randint(0, 50) for _ in range(rng.randint(0, 40))}
        places, ranks = {}, {}
        for length, low, high, times, first, at in packing.plan_slots(counts, capacity):
            for r in range(low, high):
                places.setdefault(first + (r - low) // times, []).append((at + (r - low) % times * length, length))
                ranks.setdefault(length, []).append(r)
        assert all(sorted(ranks.get(length, [])) == list(range(n)) for length, n in counts.items())
        for held in places.values():
            end = 0
            for at, length in sorted(held):
                assert at == end
                end += length
            assert end <= capacity
        assert sorted(places) == list(range(len(places)))
        assert len(places) == best_fit([x for x, n in counts.items() for _ in range(n)], capacity)
    assert len(packing.plan_slots({x: 10**9 + x for x in range(1, 1025)})) < 5_000
    with pytest.raises(ValueError):
        packing.plan_slots({1025: 1})


@pytest.mark.parametrize("capacity,broadcast", [(16, 0), (16, 4_000), (1024, 4_000)])
def test_packed_sequences_hold_all_ids(spark, messy, monkeypatch, capacity, broadcast):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BROADCAST_SHARDS", broadcast)
    plain = Tokenizer.from_file(tokenizer_path())
    docs = messy.unionByName(messy.where("doc_id = 6")).selectExpr("*", "1 AS rank", "2 AS shard", "3 AS length", "4 AS ids")
    packed = packing.pack_documents(docs, tokenizer_path(), capacity=capacity, shard_bytes=500).cache()
    got = packing.read_pieces(packed).collect()
    want, total = [], 0
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            want.append((r.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(held) == list(range(len(held)))
    for x in held.values():
        assert [o for o, _ in sorted(x)] == [0, *np.cumsum([n for _, n in sorted(x)])[:-1].tolist()]
        assert sum(n for _, n in x) <= capacity
    assert len(held) == best_fit([r.length for r in got], capacity)
    assert sum(len(r.ids) for r in packed.collect()) == 2 * total


def test_no_documents_no_sequences(nothing):
    packed = packing.pack_documents(nothing, tokenizer_path())
    assert packed.count() == 0 == packing.read_pieces(packed).count()


# ----------------------------------------------------------------------------------------- periods


def brute_runs(x, min_length=6, exponent=4):
    out = {}
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i + q < len(x):
            start = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i - start + q >= max(min_length, exponent * q) and i > start:
                out.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def words_with_runs(rng, n):
    x = []
    while len(x) < n:
        if rng.random() < 0.5:
            unit = [rng.randint(0, rng.choice([1, 2, 5, 30])) for _ in range(rng.randint(1, 7))]
            x += (unit * rng.randint(1, 9))[: rng.randint(1, 60)]
        else:
            x += [rng.randint(0, rng.choice([1, 2, 30])) for _ in range(rng.randint(1, 12))]
    return x


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        limits = rng.choice([(6, 4), (6, 4), (2, 2), (3, 2), (10, 3)])
        docs = [words_with_runs(rng, rng.randint(0, 60)) for _ in range(rng.randint(0, 8))]
        ids = np.array([w for d in docs for w in d], np.int64)
        ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
        owner, found = periods.runs_of(ids, ends, periods.Limits(*limits))
        got = [[] for _ in docs]
        for d, run in zip(owner.tolist(), found.tolist(), strict=True):
            got[d].append(tuple(run))
        assert got == [brute_runs(d, *limits) for d in docs]


def test_runs_of_long_and_repetitive_texts():
    limits = periods.Limits(6, 4)
    one = lambda x: periods.runs_of(x, np.array([len(x)]), limits)[1].tolist()
    assert one(np.zeros(100_000, np.int64)) == [[0, 100_000, 1]]
    assert one(np.arange(100_000) % 20_000) == [[0, 100_000, 20_000]]
    assert one(np.arange(100_000)) == []
    binary = np.random.default_rng(1).integers(0, 2, 3_000)
    assert [tuple(r) for r in one(binary)] == brute_runs(binary.tolist())


def test_runs_and_collapsed_texts_of_messy_documents(spark, messy, nothing):
    rng = random.Random(9)
    rows = [(100 + i, " \t".join(f"w{w}" for w in words_with_runs(rng, 120))) for i in range(40)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    clash = messy.selectExpr("doc_id", "text", "'x' AS n_words", "1 AS runs", "2 AS collapsed", "3 AS start")
    docs = clash.unionByName(more, allowMissingColumns=True)
    got = periods.find_runs(docs, shard_bytes=2_000).collect()
    assert len(got) == 48 and {"start"} < set(got[0].asDict())
    for r in got:
        words = SPACE.findall(r.text or "")
        want = brute_runs(words)
        kept = np.ones(len(words), bool)
        for start, length, period in want:
            kept[start + period : start + length] = False
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == want
        assert r.collapsed == " ".join(w for w, k in zip(words, kept, strict=True) if k)
    best = periods.find_runs(more).select("runs", periods.longest_run().alias("best")).collect()
    for r in best:
        assert r.best == (min(r.runs, key=lambda x: (-x.length, x.start, x.period)) if r.runs else None)
    assert periods.find_runs(nothing).count() == 0


def test_planted_periods(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 50)) + " ") for i in range(300)] + [(None, "a b")], "doc_id long, text string")
    for r, given in zip(with_periods(docs).collect(), docs.collect(), strict=True):
        words = SPACE.findall(given.text)
        h = zlib.crc32(str(given.doc_id).encode())
        if given.doc_id is None or h % 10:
            assert r.text == given.text
        elif words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r.text.split() == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        else:
            assert r.text == ""
