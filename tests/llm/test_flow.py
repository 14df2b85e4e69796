"""Mixing, chat formatting, grades, token files, URL filters and the pipeline."""

import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ebbwatch.llm import chat, mixing, quality, tokens, urls
from ebbwatch.llm.queries import tokenizer_path
from tools.check_oracle import TABLES, normal

LLM = [q for q in entry.queries() if re.match(r"op\d+_", q)]


@pytest.mark.parametrize("name", sorted(set(LLM) & set(entry.oracle_sql())))
def test_query_equals_sql(spark, folder, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df, result = entry.queries()[name](spark, folder), db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(normal(v) for v in row) for row in result.fetchall())
    assert sorted(tuple(normal(row[c]) for c in columns) for row in df.collect()) == want


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in LLM) == list(range(1, 14)) and "pipeline" in entry.queries()


# ------------------------------------------------------------------------------------------ mixing


@pytest.mark.parametrize("bucket", [5_000, 7])
def test_mix_meets_targets(spark, bucket):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a"] * 5 + ["b", "é", "z", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs, rows_per_bucket=bucket).toPandas()
    again = mixing.mix_sources(docs.repartition(3), rows_per_bucket=bucket).toPandas()
    key = ["doc_id"]
    assert mixed.sort_values(key).taken.tolist() == again.sort_values(key).taken.tolist()
    assert len(mixed) == 900 and mixed["size"].sum() == sum(len(t.split()) for _, t, _ in rows)
    total = 0
    for _, part in mixed.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 8
        assert part.target.iloc[0] <= 2 * part["size"].sum() + 1e-9
        total += part.target.iloc[0]
    assert total == pytest.approx(1.5 * mixed["size"].sum()) and (mixed.taken <= 2 * mixed["size"]).all()


def test_targets_fill_up_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 40), (None, 100)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a and c are full at 20 and 80 and the source without a name, of weight 3 again, at 200.
    assert got == {"a": 20.0, "b": 1.5 * 1150 - 300, "c": 80.0, None: 200.0}


def test_odds_follow_weights(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "'w' text", "if(id < 2000, 'a', 'b') source", "if(id % 2 = 0, 3.0, 1.0) likes", "1 copies")
    mixed = mixing.mix_sources(docs, weight="likes", share=0.4, rows_per_bucket=50).toPandas()
    even = mixed[mixed.doc_id % 2 == 0].taken.sum()
    assert even > 2 * (mixed.taken.sum() - even) and abs(mixed.taken.sum() - 1600) <= 2


def test_length_weighs_in_the_inclusion(spark):
    docs = spark.range(6000).selectExpr("id doc_id", "repeat('w ', if(id % 2 = 0, 100, 4)) text", "'a' source")
    mixed = mixing.mix_sources(docs, weight=F.floor(F.sqrt("size")), share=0.3, rows_per_bucket=50).toPandas()
    long, short = ((mixed[mixed["size"] == n].taken > 0).mean() for n in (100, 4))
    mean = (10 * 100 + 2 * 4) / 104
    assert abs(long - 0.3 * 10 / mean) < 0.03 and abs(short - 0.3 * 2 / mean) < 0.03
    assert abs(mixed.taken.sum() - 0.3 * mixed["size"].sum()) <= 100


def test_mix_of_messy_and_empty_tables(messy, nothing):
    rows = mixing.mix_sources(messy).collect()
    assert len(rows) == 8 and {r.taken for r in rows if r.size == 0} == {0}
    assert mixing.mix_sources(nothing).count() == 0


# -------------------------------------------------------------------------------------------- chat


def test_conversations_come_back(spark):
    rng = random.Random(3)
    bits = ["[INST] ", " [/INST]", "</s>", " </s>", "<s> ", "<<SYS>> ", " <</SYS>>", "\\", "\\0", "\\1", "\\2", "[", "<", "x", "\n", " ", "é", "[ROLE] ", " [/ROLE] ", " [/TURN]", "[NONE] ", ""]
    roles = ["user", "assistant", "system", "tool", None, "", "[ROLE] ", " [/ROLE] "]
    rows = [(c, t, rng.choice(roles), "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(-1, 0, "user", None), (-1, 1, None, None), (None, None, "user", "x"), (-2, 0, "user", "b"), (-2, 0, "user", "b"), (-2, None, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS source", "2 AS turns")
    out = chat.format_conversations(df).select("conv_id", "formatted", "loss_spans", chat.read_turns().alias("turns"), chat.loss_text().alias("loss"))
    found = {r.conv_id: r for r in out.collect()}
    assert len(found) == 63
    for conv, row in found.items():
        key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
        want = [(r[2], r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        assert [(t.role, t.text) for t in row.turns] == want
        assert row.loss == "".join(t for role, t in want if role == "assistant")
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_text_without_marks_is_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a [b] \\ <c>")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first().formatted == "[INST] a [b] \\ <c> [/INST]"


# ------------------------------------------------------------------------------------------ grades


def test_grades_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    ratings = labels.select("doc_id", quality.grade().alias("grade")).withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0)
    model = quality.train_grades(docs, ratings.where("not held").drop("held"))
    test = quality.add_grades(docs, model, tail=2).join(ratings.where("held"), "doc_id").toPandas()
    rejected = test.tail_probability < 0.4
    assert rejected[test.grade == 0].mean() > 0.8 and rejected[test.grade == 2].mean() < 0.1
    means = test.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2]
    assert (np.diff(model.thresholds) > 0).all()


def test_grades_of_messy_and_empty_tables(spark, messy, nothing):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 0, 0), (4, 1, 1), (4, 1, 0), (5, None, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int"
    )
    ratings = labels.select("doc_id", quality.grade().alias("grade"))
    model = quality.train_grades(messy, ratings)
    rows = quality.add_grades(messy, model).collect()
    assert len(rows) == 8 and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert not quality.train_grades(nothing, ratings).weights.any() and quality.add_grades(nothing, model).count() == 0
    assert [r.grade for r in labels.select(quality.grade().alias("grade")).collect()] == [2, 1, 1, 0, 2, None, 0, None]


def test_fit_equals_a_dense_reference():
    rng = np.random.default_rng(3)
    buckets = 40
    rows = [np.unique(rng.integers(0, buckets, rng.integers(1, 9))).astype(np.int32) for _ in range(60)]
    grades = rng.integers(0, 3, 60)
    model = quality.fit_ordinal(rows, grades, 3, rounds=30)
    x = np.zeros((60, buckets))
    for i, r in enumerate(rows):
        x[i, r] = 1 / np.sqrt(len(r))
    share = 1 / (3 * np.bincount(grades, minlength=3))[grades]

    def loss(p):
        cuts = np.array([p[-2], p[-2] + np.exp(p[-1])])
        tail = 1 / (1 + np.exp(-((x @ p[:-2])[:, None] - cuts)))
        above = grades[:, None] >= np.array([1, 2])
        # The penalty is counted apart: its slope is 2e-5 times the weight.
        return -(share[:, None] * np.where(above, np.log(tail), np.log1p(-tail))).sum() + 1e-5 * (p[:-2] ** 2).sum()

    p, m, v = np.zeros(buckets + 2), np.zeros(buckets + 2), np.zeros(buckets + 2)
    rate = np.append(np.full(buckets, 1.5), [0.15, 0.15])
    for t in range(1, 31):
        slope = np.array([(loss(p + e) - loss(p - e)) / 2e-5 for e in np.eye(len(p)) * 1e-5])
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.abs(model.weights[:buckets] - p[:-2]).max() < 1e-2 and not model.weights[buckets:].any()
    assert np.abs(model.thresholds - [p[-2], p[-2] + np.exp(p[-1])]).max() < 1e-2


def test_many_documents_of_one_rated_id_count_once(spark):
    docs = spark.range(2_000).selectExpr("if(id < 1990, 1, id) doc_id", "concat('text ', id % 1990) text")
    ratings = spark.range(3_000).selectExpr("id doc_id", "cast(id % 3 as int) grade")
    smallest = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    few = docs.where(~((F.col("doc_id") == 1) & (F.col("text") != smallest)))
    a, b = quality.train_grades(docs, ratings), quality.train_grades(few, ratings)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.thresholds, b.thresholds) and a.weights.any()


# ------------------------------------------------------------------------------------------ tokens


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(6)
    bits = [" ", "  ", "\n", "\t", " ", "\x1c", "\0", "a", "It's", "'s", "word", "Größe", "²", "12", ".", ",", "$$$", "_", "<|endoftext|>", "漢字", "\U0001f600", "ñ"]
    texts = ["", " "] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    encoder = tokens.Encoder(tokenizer_path())
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_files_hold_the_stream(spark, messy, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    folder = f"file://{tmp_path}/out"
    shards = tokens.write_tokens(messy, folder, tokenizer_path(), length=16, shard_bytes=1_000)
    got = sorted(tokens.read_tokens(shards, folder).collect(), key=lambda r: r.start)
    rows = sorted(messy.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    stream, want = [], []
    for r in rows:
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, len(stream), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        stream += ids
    assert [tuple(r) for r in got] == want
    store = pa.fs.LocalFileSystem()
    read = []
    for shard in sorted(shards.collect(), key=lambda s: s.shard):
        reader = tokens.ShardReader(store, f"{tmp_path}/out/part-{shard.shard:06d}.arrow")
        assert reader.file.schema.field("ids").type == pa.list_(pa.uint16(), 16)
        for i in range(-(-shard.n_tokens // 16)):
            ids, mask = reader.sequence(i)
            assert len(ids) == len(mask) == 16
            read += ids[mask].tolist()
    assert read == stream
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]


def test_no_documents_no_files(spark, nothing):
    assert tokens.encode_corpus(nothing, tokenizer_path()).count() == 0


# -------------------------------------------------------------------------------------------- URLs


def test_urls_equal_brute_force(spark):
    rng = random.Random(12)
    hosts = ["a.example.net", "example.net", "xexample.net", "org", "a.org", "EXAMPLE.com", "b.example.com", "spam-farm.example.org", "net", "", ".net", "a..net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/", "/fr/x/y", "/x?/en/", "?q=://", "#/en/"]
    rows = [(i, rng.choice(["http://", "://", "", "https://", "x"]) + rng.choice(hosts) + rng.choice(paths)) for i in range(400)]
    rows += [(None, "http://a.net/"), (1, None), (1, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS html", "1 AS host", "2 AS rule", "3 AS key")
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, urls.rule_frame(spark), urls.host_frame(spark)).collect()), key=str)

    def judge(page, url):
        at = (url or "").find("://")
        rest = url[at + 3 :] if url and at >= 0 else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        under = lambda h: host == h or host.endswith("." + h)
        fit = [(len(h + p), h + p, v) for h, p, v in urls.RULES if under(h) and path.startswith(p)]
        if fit:
            return page, url, host, path, *max(fit)[1:]
        spam = any(under(h) and path.startswith("/") for h in urls.SPAM_HOSTS)
        return page, url, host, path, None, "block" if spam else "allow"

    assert got == sorted((judge(*r) for r in rows), key=str)
    assert urls.judge_urls(pages.limit(0), urls.rule_frame(spark)).count() == 0
    assert urls.judge_urls(pages, urls.rule_frame(spark).limit(0)).where("verdict != 'allow'").count() == 0


def test_many_entries_pass_the_filter_exactly(spark):
    listed = spark.range(5000).selectExpr("concat('h', id, '.test') host", "'/p' path", "'block' verdict")
    pages = spark.range(10000).selectExpr("id page_id", "concat('http://www.h', id, '.test/p') url")
    judged = urls.judge_urls(pages, listed)
    assert judged.where("verdict = 'block'").count() == 5000 == judged.where("page_id < 5000 and rule is not null").count()
    blocks = urls.bloom_blocks(listed.selectExpr("concat(host, path) key"), "key", 160)
    asked = pages.selectExpr("concat('h', page_id, '.test/p') asked").withColumn("at", urls._block(F.col("asked"), 160))
    passed = asked.join(blocks, F.col("at") == F.col("block")).where(urls._may_hold("words", "asked")).count()
    assert 5000 <= passed <= 5250


def test_listed_urls_are_met_in_canonical_form(spark):
    bodies = ["<body>a</body>", "<body>b\n</body>", "", None, "<body></body>"]
    rows = [
        (1, "http://A.test/x/y", bodies[0]), (2, "http://b.test:80//x///y/", bodies[0]), (3, "http://b.test./x/y?q", bodies[1]),
        (4, "http://b.test/x/y/z", bodies[1]), (5, "http://c.test", bodies[2]), (6, "http://c.test", bodies[3]),
        (7, "http://d.test/", bodies[4]), (8, "http://e.net/x", bodies[1]), (9, None, bodies[1]), (10, "no url", bodies[0]),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS body", "2 AS key")
    listed = urls.mirrored_urls(pages)
    assert sorted((r.url or "") for r in listed.collect()) == ["", "http://b.test/x/y/z", "http://b.test:80//x///y/", "http://e.net/x", "no url"]
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, urls.rule_frame(spark), None, listed).collect()}
    # b.test/x/y is listed by its second form; a rule wins over the list.
    assert [i for i, (_, v) in found.items() if v == "block"] and {i for i, (_, v) in found.items() if v == "block"} == {2, 3, 4, 8}
    assert found[8] == ("net/", "block") and found[1] == (None, "allow")
    none = urls.judge_urls(pages, urls.rule_frame(spark), None, listed.limit(0))
    assert none.where("verdict = 'block'").count() == 1


# ---------------------------------------------------------------------------------------- pipeline


def test_pipeline_stages_keep_their_promises(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now, columns = docs, docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == columns, name
        now = now.cache()
        sizes.append(now.count())
    assert sizes[1] < sizes[0] and sizes[2] <= sizes[1] and sizes[3] <= sizes[2]
    final = corpus_pipeline.STAGES[-1][1](spark, now, folder).toPandas().sort_values("start")
    assert len(final) == sizes[-1]
    assert final.start.tolist() == [0, *final.n_tokens.cumsum().tolist()[:-1]]
    assert final.doc_id.is_monotonic_increasing


def test_pipeline_on_messy_documents(spark, messy, folder):
    clash = [f"'{c}' AS {c}" for c in ("copies", "expected_grade", "tail_probability", "words_removed", "_row1", "_kept1", "_left", "_c0", "grade")]
    docs = messy.selectExpr("*", *clash)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        if name != "token ids":
            assert out.columns == columns, name
            kept = {tuple(r[c] for c in columns if c not in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows}
            assert kept <= {("x", 1, 2, 3, 4, 5, 6, 7, 8, 9, *[c.split(" ")[-1] for c in clash])}, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
        docs = out


def test_stages_work_without_a_size_column_and_without_ratings(spark, messy, folder):
    docs = messy.select("doc_id", "text", "source")
    assert corpus_pipeline.cut_benchmark(spark, docs, folder).count() == 8
    far = docs.withColumn("doc_id", F.col("doc_id") + 10_000_000)
    assert corpus_pipeline.keep_quality(spark, far, folder).count() == 8


def test_repeated_rows_are_mixed_once_each(spark):
    rows = [(1, "a b c", "en", "x", 5)] * 3 + [(2, "d", "en", "x", 1), (2, "e", "en", "x", 1), (None, "f g", "en", "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix(spark, docs, "")
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert abs(words - 1.5 * 13) <= 2
