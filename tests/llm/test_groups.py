"""Near-copies of texts and vectors against comparing all with all."""

import random
import re

import numpy as np
import pytest
import xxhash

from ebbwatch.llm import simhash, vectors
from ebbwatch.llm.components import connected

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_fingerprint(text, n=3):
    w = SPACE.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdeÄé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 400))] for _ in range(60)]
    out = [" ".join(b) for b in base] + [None, "", " \n", "one", "one two", "ONE  two"]
    for b in base:
        for _ in range(3):
            copy = list(b)
            copy[rng.randrange(len(copy))] = "changed"
            out.append("\t".join(copy))
    return out + out[:10]


def test_fingerprints_and_components_equal_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in simhash.group_near_copies(df).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    assert [rows[i].fingerprint % (1 << 64) for i in range(len(texts))] == prints
    want = brute_components(len(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert [rows[i].component_id for i in range(len(texts))] == want
    assert len(set(want)) < len(texts) - 20


def test_no_close_pair_is_missed_by_the_lists():
    assert len(simhash.KEYS) == 14
    for n in (1, 2, 3):
        for apart in __import__("itertools").combinations(range(8), n):
            assert any(not set(key) & set(apart) for key in simhash.KEYS)


@pytest.mark.parametrize("direct, small", [(1 << 17, 256), (1 << 17, 1), (2, 1)])
def test_long_lists_are_searched_whole(spark, monkeypatch, direct, small):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(4)
    prints = np.unique(rng.integers(0, 1 << 12, 120).astype(np.uint64) << np.uint64(20))
    want = brute_components(len(prints), lambda a, b: int(prints[a] ^ prints[b]).bit_count() <= 2)
    root = simhash.forest(prints[:, None], simhash.accept_close(2), 2)
    assert root.tolist() == want


@pytest.mark.parametrize("direct", [1, 1 << 20])
def test_a_list_around_a_middle_is_linked_whole(monkeypatch, direct):
    """Fingerprints up to 5 bits from one, and others far from it, some of them linked to each other."""
    monkeypatch.setattr(simhash, "DIRECT", direct)
    rng = np.random.default_rng(14)
    flip = lambda base, k: base ^ sum(1 << int(b) for b in rng.choice(32, k, replace=False))
    prints = [flip(0xABCD << 32 | 0x1234567, int(rng.integers(0, 6))) for _ in range(400)]
    far = [int(rng.integers(0, 1 << 32)) | 0xABCD << 32 for _ in range(100)]
    prints += far + [p ^ 1 << 3 for p in far]
    prints = np.unique(np.array(prints, np.uint64))
    want = brute_components(len(prints), lambda a, b: int(prints[a] ^ prints[b]).bit_count() <= 3)
    root = simhash.forest(prints[:, None], simhash.accept_close(3), 3)
    assert len({(a, b) for a, b in zip(root.tolist(), want, strict=True)}) == len(set(want)) == len(set(root.tolist()))


@pytest.mark.parametrize("block, sampled", [(4, 1), (8, 2), (64, 1)])
def test_lists_in_tiles_equal_brute_force(spark, monkeypatch, block, sampled):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SAMPLED", sampled)
    rng = random.Random(15)
    base = [rng.getrandbits(64) for _ in range(5)]
    prints = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) for b in base for _ in range(60)})
    prints = [p - (1 << 64) if p >= 1 << 63 else p for p in {p % (1 << 64) for p in prints}]
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    want = brute_components(len(prints), lambda a, b: ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= 3)
    found = {r.node: r.component for r in connected(simhash.link_fingerprints(df)).collect()}
    got = [found.get(p, p) for p in prints]
    assert len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))
    assert len(set(want)) < len(prints) // 2


def test_one_of_each_group_stays(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "alone with no id at all"), (0, "another text of id nought")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS _row1", "'x' AS fingerprint", "4 AS component")
    kept = simhash.keep_one_of_each(df)
    assert kept.columns == ["doc_id", "text", "node", "_row1", "fingerprint", "component"]
    prints = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    groups = {}
    for (i, t), r in zip(rows, root, strict=True):
        groups.setdefault(r, []).append((i is None, i or 0, t))
    got = {r: 0 for r in groups}
    of_text = {(i, t): r for (i, t), r in zip(rows, root, strict=True)}
    for r in kept.collect():
        got[of_text[r.doc_id, r.text]] += 1
        assert (r.doc_id is None, r.doc_id or 0) == min(g[:2] for g in groups[of_text[r.doc_id, r.text]])
    assert set(got.values()) == {1}


def test_rows_of_one_id_with_other_texts_stay(spark):
    rng = random.Random(6)
    a, b = (" ".join(str(rng.random()) for _ in range(50)) for _ in range(2))
    df = spark.createDataFrame([(1, a), (1, b), (1, b), (2, a)], "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(df).collect())
    assert kept == sorted([(1, a), (1, b)])


def test_messy_and_empty_documents(messy, nothing):
    rows = simhash.group_near_copies(messy).collect()
    assert len(rows) == 8
    empty = [r for r in rows if r.fingerprint == 0]
    assert len(empty) == 3 and {r.component_id for r in empty} == {2}
    assert simhash.group_near_copies(nothing).count() == 0 and simhash.keep_one_of_each(nothing).count() == 0
    assert simhash.keep_one_of_each(messy).count() == len({r.component_id for r in rows})


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{i: 1000 for i in range(1000, 1100)}}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(40, 32))
    x = np.concatenate([centers + rng.normal(size=centers.shape) * s for s in (0, 0.05, 0.1, 0.2, 0.25)] + [centers[:5]] * 3)
    x = np.concatenate([x, centers[0] + rng.normal(size=(80, 32)) * 0.1])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    rows = {r.vec_id: r for r in vectors.link_vectors(df, block_rows=block).collect()}
    found = np.array([rows[i].n_links for i in range(len(x))])
    assert (found <= close.sum(axis=1)).all() and found.sum() >= 0.98 * close.sum()
    want = brute_components(len(x), lambda a, b: close[a, b])
    got = [rows[i].component_id for i in range(len(x))]
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.98
    assert all(rows[i].kept == (rows[i].component_id == i) for i in range(len(x)))


def test_a_dense_group_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MIN_PIVOTS", 512)
    rng = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    group = unit(rng.normal(size=64)) + rng.normal(size=(1_500, 64)) * 0.175 / 8
    x = unit(np.concatenate([group, rng.normal(size=(3_000, 64))]))
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    assert close[:1_500, :1_500].mean() > 0.9
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = {r.vec_id: r for r in vectors.link_vectors(df).collect()}
    found = np.array([rows[i].n_links for i in range(len(x))])
    assert (found <= close.sum(axis=1)).all() and found.sum() >= 0.99 * close.sum()
    assert {rows[i].component_id for i in range(1_500)} == {0}


def test_links_inside_wide_groups_are_found(spark, monkeypatch):
    """Groups of inner cosine 0.85, wider than the thinning, with pairs at 0.95 to 0.97 in them, under many pivots."""
    monkeypatch.setattr(vectors, "MIN_PIVOTS", 1_024)
    rng = np.random.default_rng(31)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    dims = 128
    center = np.repeat(unit(rng.normal(size=(40, dims))), 50, axis=0)
    member = unit(center + unit(rng.normal(size=center.shape)) * 0.42)
    copy = unit(member + unit(rng.normal(size=center.shape)) * rng.uniform(0.25, 0.32, (len(center), 1)))
    x = np.concatenate([member, copy, unit(rng.normal(size=(1_000, dims)))])
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    assert 0.8 < (member[:50] @ member[:50].T).mean() < 0.9 and close.sum() >= 3_600
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in vectors.link_vectors(df).collect()}
    assert all(found[i] <= n for i, n in enumerate(close.sum(axis=1)))
    assert sum(found.values()) >= 0.95 * close.sum()


@pytest.mark.parametrize("setting", [(8, 2), (12, 6), (24, 24), (3, 1)])
def test_pairs_that_share_enough_are_counted_once(spark, setting):
    rng = np.random.default_rng(5)
    center = rng.normal(size=(30, 16))
    x = np.concatenate([center + rng.normal(size=center.shape) * s for s in (0.0, 0.1, 0.2, 0.3)]).round(3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    nodes = df.selectExpr("vec_id", "xxhash64(embedding) AS node").orderBy("node").collect()
    pivots = vectors.thin(unit[[r.vec_id for r in nodes]], 64, 0.9)
    near = vectors._closest(unit, pivots)[:, : setting[0]]
    shared = np.array([[len(set(a) & set(b)) for b in near.tolist()] for a in near.tolist()])
    linked = (unit @ unit.T >= 0.95) & (shared >= setting[1])
    np.fill_diagonal(linked, False)
    for block in (4, 4_096):
        found = {r.vec_id: r.n_links for r in vectors.link_vectors(df, setting=setting, block_rows=block).collect()}
        assert [found[i] for i in range(len(x))] == linked.sum(axis=1).tolist()


def test_unusable_and_mixed_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (11, [1e300, 1e290]), (None, [0.0, 1.0]), (12, [0.0, -1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "5 AS node", "6 AS list")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(df).collect()), key=str)
    linked = [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (11, 4, 1, False)]
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 12, None)]
    assert got == sorted(linked + alone, key=str)
    assert vectors.link_vectors(df.limit(0)).count() == 0
