"""Decontamination, license and secret scans against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbwatch.llm import decontaminate as dc
from ebbwatch.llm import licenses, secrets

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_contamination(docs, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        yield len(w), hit, {str(i) for i in found if i is not None}


@pytest.fixture(scope="module")
def passages(spark):
    rng = random.Random(7)
    some = lambda n: " ".join(rng.choice("ab b c d É 7 x").strip() or "a" for _ in range(n))
    items = [(i, some(rng.randint(1, 14))) for i in range(12)] + [(12, "a"), (13, ""), (14, None), (None, "c c c"), (3, "b c")]
    docs = [some(rng.randint(0, 300)) for _ in range(40)]
    docs += [docs[0], docs[0] + " " + docs[1], None, "", "A, b! a"]
    return list(enumerate(docs)), items


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 200}, {"block_bytes": 30}])
def test_contamination_equals_brute_force(spark, passages, options):
    docs, items = passages
    found = dc.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
        **options,
    )
    rows = {r.doc_id: r for r in found.collect()}
    for (i, _), (n, hit, ids) in zip(docs, brute_contamination([d for _, d in docs], items, 4), strict=True):
        assert rows[i].n_words == n and set(rows[i]["items"]) == ids
        assert {p for s in rows[i].spans for p in range(s.start, s.end)} == hit


def test_index_counts_and_locates():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 4, 500).astype(np.int32)
    text[-1] = 0
    index = dc.FMIndex(text, 4, sample=8)
    for phrase in ([1], [2, 3], [1, 1, 2], [3, 3, 3, 3]):
        low, high = index.search(np.array([phrase[::-1]]))
        want = [i for i in range(500) if text[i : i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


@pytest.mark.parametrize("options", [{}, {"block_bytes": 10}, {"shard_bytes": 20}])
def test_removal_cuts_only_the_spans(spark, options):
    docs = spark.createDataFrame(
        [(1, "Keep this. Secret TEST phrase, here! And that."), (2, None), (3, "nothing"), (4, "secret test phrase here"), (5, "")],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(1, "secret test phrase here"), (2, "this secret test")], "item_id long, text string")
    cut = dc.remove_contamination(docs, bench, **options)
    assert cut.columns == ["doc_id", "text", "words_removed"]
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Keep ! And that.", 2: None, 3: "nothing", 5: ""}
    assert {r.doc_id: r.words_removed for r in cut.collect()} == {1: 5, 2: 0, 3: 0, 5: 0}


def test_a_large_benchmark_is_cut_in_chunks():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}".encode() for i in range(50_000)]
    items = [(str(i), b" ".join(vocabulary[k] for k in rng.integers(0, 50_000, 35_000))) for i in range(100)]
    assert sum(len(t) for _, t in items) > 20_000_000
    phrases = dc.Phrases(items, 10)
    assert phrases.words.nbytes < 16_000_000
    passage = items[57][1].split()[1_000:1_012]
    counts, found, flags = phrases.find([b"before " + b" ".join(passage) + b" after", b"nothing here"])
    assert counts.tolist() == [14, 2] and found == [{"57"}, set()]
    assert np.flatnonzero(flags[0]).tolist() == list(range(1, 13)) and 1 not in flags


def test_contamination_of_messy_and_empty_tables(spark, messy, nothing):
    bench = spark.createDataFrame([(1, "plain words of")], "item_id long, text string")
    rows = dc.find_contamination(messy, bench).select("doc_id", "n_words", "spans").collect()
    assert len(rows) == 8 and sum(len(r.spans) for r in rows) == 2
    assert sorted(r.n_words for r in rows) == [0, 0, 0, 5, 5, 5, 6, 20_000]
    assert dc.find_contamination(nothing, bench).count() == 0
    assert dc.find_contamination(messy, bench.limit(0)).where("size(spans) > 0").count() == 0


def brute_licenses(text, threshold=0.8):
    w = words(text)
    best = {}
    for label, needed, template in licenses.TEMPLATES:
        t, half = set(words(template)), 8
        while half < len(words(template)):
            half *= 2
        for start in range(0, max(1, len(w) - half), half):
            held, inside = set(w[start : start + 2 * half]), " ".join(["", *w[start : start + 2 * half], ""])
            share = len(held & t) / len(t)
            if share >= threshold and f" {needed} " in inside:
                best[label] = max(best.get(label, 0), share)
    base = [(i, v) for p, v in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), sorted(i for i, _ in base), {v for _, v in base}, best


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under CC BY 4.0", "cc-by"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa"),
        ("Creative Commons Attribution 4.0 International License", "cc-by"),
        ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("Released under the BSD License", "bsd"),
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Mozilla License, Version 2.0", ""),
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("The birds were released from the cage under the old license of the town, mit Freude.", ""),
        ("He was licensed to sell, and under the version of the story they released, 2 or 0 of them.", ""),
        ("All rights reserved.", "reserved"),
    ],
)
def test_labels_of_notices_stated_by_hand(spark, text, labels):
    padded = f"some words before it. {text} and some words after it"
    row = licenses.scan_licenses(spark.createDataFrame([(1, padded)], "doc_id long, text string")).first()
    assert ",".join(row.labels) == labels


def test_whole_license_texts_are_found_in_long_documents(spark):
    rng = random.Random(8)
    rows = []
    for label, _, text in licenses.TEMPLATES:
        filler = [" ".join(rng.choice("uno dos tres the of and to".split()) for _ in range(rng.randint(0, 700))) for _ in range(2)]
        rows.append((label, f"{filler[0]} {text} {filler[1]}"))
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect():
        assert r.doc_id in r.labels


def test_licenses_equal_brute_force(spark):
    rng = random.Random(5)
    filler = "the of and to license version under all rights public words some text".split()
    texts = [None, "", "CC BY cc-by; general PUBLIC license. All rights reserved all rights reserved"]
    for _ in range(60):
        w = [rng.choice(filler) for _ in range(rng.randint(0, 250))]
        t = words(rng.choice(licenses.TEMPLATES)[2])
        t = [x for x in t if rng.random() < 0.9]
        at = rng.randint(0, len(w))
        texts.append(" ".join(w[:at] + t + w[at:]))
    rows = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    hits = 0
    for i, text in enumerate(texts):
        n, starts, base, best = brute_licenses(text)
        hits += bool(best)
        r = rows[i]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(starts), sorted(base))
        assert (r.first_word, r.last_word) == ((starts[0], starts[-1]) if starts else (None, None))
        assert r.labels == sorted(base | set(best))
        assert r.score == pytest.approx(1.0 if starts else max(best.values(), default=0.0))
    assert hits > 20


def test_licenses_of_messy_and_empty_tables(messy, nothing):
    rows = licenses.scan_licenses(messy).collect()
    assert len(rows) == 8 and sum(r.n_base for r in rows) == 1 and licenses.scan_licenses(nothing).count() == 0


ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def brute_secrets(text):
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_secrets_equal_brute_force(spark):
    rng = random.Random(11)
    bits = ["token", "TOKEN=", "api_key: ", "apiKey='", "secret", "=", ":", " ", "\"", "abcdef", "0123456789abcdef", "AKIA", "QWERTY012345", "é", "ſecret=", "漢", "passwd = ", "password", "x", "\n", "\0", "K"]
    texts = [None, "", "token=secret=abcdefgh", "AKIA" * 6, "secret=" + "deadbeef" * 4]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    total = 0
    for r in secrets.find_secrets(df, shard_bytes=500).collect():
        got = [(s.kind, s.start, s.end) for s in r.secrets]
        assert got == brute_secrets(texts[r.doc_id])
        total += len(got)
    assert total > 100


def test_checksums_decide(spark):
    body = b"a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    right = (body + secrets.checksum62(body)).decode()
    wrong = right[:-1] + ("0" if right[-1] != "0" else "1")
    df = spark.createDataFrame([(f"ü ghp_{right}, ghp_{wrong} npm_{right} ghp_{right}0",)], "text string")
    row = secrets.find_secrets(df).select("secrets", secrets.listed().alias("all"), secrets.listed(True).alias("base")).first()
    assert row["all"] == "github:2:42,npm:85:125" and row.base == ""


def test_secrets_of_messy_and_empty_tables(messy, nothing):
    assert secrets.find_secrets(messy).where(F.size("secrets") > 0).count() == 0
    assert secrets.find_secrets(nothing).count() == 0
