"""Row texts, vectors, intent and tokens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbwatch.functions import texts, vectors
from ebbwatch.functions.scalar import contains_any
from ebbwatch.constants import LEAVING_KEYWORDS
from ebbwatch.operators import textual as T

BEHAVIOUR = "dias_sin_app double, var_saldo_pct double, var_transacciones_pct double, num_productos int, reclamos_6m int, antiguedad_anos double, score_satisfaccion double"


EXPECTED = [
    "Cliente con 2.5 años de antigüedad. Sin uso de app móvil hace 71 días (inactividad severa). Reducción severa de saldo (-37% en 3 meses). "
    "Frecuencia transaccional cayó 44% vs histórico. Cliente con un único producto activo (baja vinculación). "
    "Registra 5 reclamos en los últimos 6 meses. Score de satisfacción bajo: 1.5/10.",
    "Cliente con 4.0 años de antigüedad. Baja actividad digital, sin app hace 33 días. Disminución moderada de saldo (-18%). "
    "Frecuencia transaccional estable. Vinculación media: 2 productos activos.",
    "Cliente con 12.5 años de antigüedad. Activo en app móvil (último acceso hace 4 días). Saldo estable (9%). "
    "Frecuencia transaccional estable. Alta vinculación: 6 productos activos. Sin reclamos recientes. Alta satisfacción declarada: 9.0/10.",
]


def test_narratives(spark):
    rows = [(71.0, -37.0, -44.0, 1, 5, 2.5, 1.5), (33.0, -18.0, -11.0, 2, 1, 4.0, 5.5), (4.0, 9.0, 3.0, 6, 0, 12.5, 9.0)]
    got = [r.t for r in spark.createDataFrame(rows, BEHAVIOUR).coalesce(1).select(texts.narrative().alias("t")).collect()]
    assert got == EXPECTED


def test_labelled_row(spark):
    row = spark.sql(
        "SELECT 62 AS edad, 'femenino' AS genero, 'Alemania' AS pais, 1 AS `antiguedad_años`, 0.0D AS saldo, 4 AS num_productos, 0 AS tiene_tarjeta, "
        "0 AS miembro_activo, 20000.0D AS salario_estimado, 3 AS quejas_recibidas, 1 AS uso_app_movil, 400 AS score_credito"
    )
    assert row.select(texts.labelled_row_text().alias("t")).collect()[0].t == (
        "edad: 62, genero: femenino, pais: Alemania, antiguedad: 1 años, saldo: nulo, productos: 4, tarjeta credito: no, "
        "miembro activo: no, salario: bajo, quejas: 3, usa app movil: si, score credito: muy bajo"
    )


def test_level_cuts(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([0, 1, 50000, 120000, 200000])], "i int, x double")
    assert [r.y for r in df.select("i", texts.balance_level("x").alias("y")).orderBy("i").collect()] == ["nulo", "bajo", "medio", "alto", "muy alto"]


def test_vector_arithmetic(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>").coalesce(1)
    rows = df.select(vectors.l2_normalize("a").alias("u"), vectors.cosine("a", "b").alias("c"), vectors.dot("a", "b").alias("d")).collect()
    assert rows[0].u == [0.6, 0.8] and rows[0].c == pytest.approx(0.96) and rows[0].d == 24.0
    assert rows[1].u == [0.0, 0.0] and rows[1].c == 0.0


def anchors(spark):
    return spark.createDataFrame([(0, "churn", [1.0, 0.0]), (1, "churn", [0.8, 0.6]), (2, "retention", [0.0, 1.0])], "anchor int, kind string, vector array<double>")


def test_intent_and_anchor_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, embedding array<double>")
    got = {r.id: r.churn_intent_score for r in T.churn_intent(df, anchors(spark)).collect()}
    assert got == {1: pytest.approx(1.0), 2: pytest.approx(0.1)}
    pairs = T.text_x_anchor(df, anchors(spark))
    assert pairs.count() == 6
    assert "CartesianProduct" not in pairs._jdf.queryExecution().toString() and "NestedLoop" not in pairs._jdf.queryExecution().toString()


def test_highest_cosine_equals_comparing_all(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=8)
    vectors = np.concatenate([centre + rng.normal(size=(3_000, 8)) * 0.05, rng.normal(size=(2_000, 8)), np.zeros((1, 8))])
    asked = np.concatenate([rng.normal(size=(200, 8)), centre[None, :], np.zeros((1, 8))])
    unit = lambda x: np.divide(x, np.linalg.norm(x, axis=1, keepdims=True), out=np.zeros_like(x), where=np.linalg.norm(x, axis=1, keepdims=True) > 0)
    block = T.AnchorBlock(vectors)
    assert np.allclose(block.highest(unit(asked)), (unit(asked) @ unit(vectors).T).max(axis=1), atol=1e-12)
    anchors = spark.createDataFrame([(i, "churn" if i % 3 else "retention", v.tolist()) for i, v in enumerate(vectors)], "anchor int, kind string, vector array<double>")
    df = spark.createDataFrame([*((i, v.tolist()) for i, v in enumerate(asked)), (-1, None)], "id int, embedding array<double>")
    want = (unit(asked) @ unit(vectors[[i for i in range(len(vectors)) if i % 3]]).T).max(axis=1)
    for size in (None, 700):
        rows = {r.id: r for r in T.max_anchor_similarity(df, anchors, block=size).collect()}
        assert np.allclose([rows[i].churn_similarity for i in range(len(asked))], want, atol=1e-12)
        assert rows[-1].churn_similarity == 0.0 and rows[-1].embedding is None
    with pytest.raises(Exception, match="entries meet anchors"):
        T.max_anchor_similarity(spark.createDataFrame([(1, [1.0])], "id int, embedding array<double>"), anchors).collect()


def test_the_plan_does_not_grow_with_the_anchors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "id int, embedding array<double>")
    many = spark.range(100_000).select(F.col("id").cast("int").alias("anchor"), F.lit("churn").alias("kind"), F.array(F.cos("id"), F.sin("id")).alias("vector"))
    size = lambda n: len(T.max_anchor_similarity(df, many.limit(n))._jdf.queryExecution().executedPlan().toString())
    assert abs(size(10) - size(100_000)) < 200
    assert T.max_anchor_similarity(df, many).first().churn_similarity == pytest.approx(1.0)


def test_any_number_of_anchors_in_blocks(spark):
    many = spark.range(5000).select(
        F.col("id").cast("int").alias("anchor"),
        F.when(F.col("id") % 2 == 0, "churn").otherwise("retention").alias("kind"),
        F.array(F.cos(F.col("id") / 1000), F.sin(F.col("id") / 1000)).alias("vector"),
    )
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, embedding array<double>")
    assert T.text_x_anchor(df, many, block=700).count() == 10_000
    rows = {r.id: r for r in T.max_anchor_similarity(df, many).collect()}
    assert rows[1].churn_similarity == pytest.approx(1.0) and rows[2].retention_similarity == pytest.approx(1.0, abs=1e-6)
    none = T.churn_intent(df, many.where("kind = 'churn'").limit(0)).collect()
    assert len(none) == 2 and none[0].churn_similarity is None


def test_labels_and_dimension_come_from_the_data(spark):
    df = spark.range(24).select((F.col("id") % 12).alias("label"), F.transform(F.sequence(F.lit(1), F.lit(384)), lambda i: F.sin(i * F.col("id"))).alias("embedding"))
    anchors = T.label_anchors(df).collect()
    assert len(anchors) == 12 and {len(r.vector) for r in anchors} == {384}
    ragged = spark.createDataFrame([(0, [1.0]), (0, [1.0, 2.0])], "label int, embedding array<double>")
    with pytest.raises(ValueError, match="length"):
        T.label_anchors(ragged)


def test_no_text_is_lost(spark):
    df = spark.createDataFrame([(1, "quiero cerrar mi cuenta"), (2, None), (3, ""), (4, "otra cosa"), (5, "excelente atención al cliente")], "id int, t string")
    rows = {r.id: r for r in T.text_intent(df, "id", "t").collect()}
    assert len(rows) == 5 and rows[1].churn_similarity == pytest.approx(1.0) and rows[5].retention_similarity == pytest.approx(1.0)
    assert [rows[i].churn_intent_score for i in (2, 3, 5)] == [0.0, 0.0, 0.0]
    dense = {r.id: r.embedding for r in T.dense_text_vectors(df, "id", "t", 8).collect()}
    assert len(dense) == 5 and dense[2] == [0.0] * 8 and sum(x * x for x in dense[1]) == pytest.approx(1.0)


def test_pooling_keeps_words_without_a_vector(spark):
    docs = spark.createDataFrame([(1, "a b c a"), (2, ""), (3, None)], "id int, t string")
    bucket = lambda w: int(__import__("hashlib").md5(w.encode()).hexdigest()[:8], 16) % 1000
    tokens = spark.createDataFrame([(bucket("a"), [3.0]), (bucket("b"), [6.0]), (999, [0.0])], "bucket long, embedding array<double>")
    rows = {r.id: r for r in T.mean_pooling(docs, "id", "t", tokens).collect()}
    known = 3 + (bucket("c") in (bucket("a"), bucket("b"), 999))
    assert (rows[1].n_tokens, rows[1].n_known) == (4, known) and rows[2].n_tokens == 0 and rows[3].embedding is None
    if known == 3:
        assert rows[1].embedding == [4.0]


def test_customer_embedding_is_mean_and_max(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0], 0.2), ("a", [0.0, 1.0], 0.9), ("b", [2.0, 2.0], 0.1)], "customer_id string, embedding array<double>, churn_intent_score double")
    rows = {r.customer_id: r for r in T.customer_embedding(df, 2).collect()}
    assert rows["a"].embedding == [0.5, 0.5] and rows["a"].churn_intent_score == 0.9 and rows["a"].n_texts == 2
    assert T.vector_dimension(df).collect()[0].asDict() == {"dim": 2, "n": 3, "agrees": True}


def test_lexical_intent_separates_leaving_from_staying(spark):
    df = spark.createDataFrame(
        [("Voy a retirar mi dinero y cerrar la cuenta, muy insatisfecho",), ("La atención al cliente es excelente, lo recomendaría a mis conocidos",), (None,), ("",)], "t string"
    ).coalesce(1)
    leave, stay, missing, empty = [r.s for r in df.select(T.lexical_intent_udf()("t").alias("s")).collect()]
    assert leave > 0.3 and stay < leave / 2 and missing == empty == 0.0


def test_keywords(spark):
    df = spark.createDataFrame([("Quiero CERRAR mi cuenta",), ("La app NO funciona",), ("todo bien",)], "t string").coalesce(1)
    assert [r.k for r in df.select(contains_any("t", LEAVING_KEYWORDS).alias("k")).collect()] == [True, True, False]


def test_token_windows_cover_the_whole_text(spark):
    words = [f"w{i}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, ""), (3, "Uno, DOS")], "id int, text string")
    rows = {(r.id, r.window_no): r for r in T.token_windows(df, "id", "text").collect()}
    assert [rows[1, w].n_tokens for w in range(3)] == [128, 128, 44]
    assert [t for w in range(3) for t in rows[1, w].tokens if t != "[PAD]"] == words
    assert rows[2, 0].n_tokens == 0 and len(rows[2, 0].tokens) == 128
    assert rows[3, 0].tokens[:2] == ["uno", "dos"] and sum(rows[3, 0].mask) == 2


def test_text_vectors_have_unit_length(spark):
    df = spark.createDataFrame([(1, "a b c a"), (2, "a x y"), (3, "")], "id int, text string")
    lengths = T.text_vectors(df, "id", "text", 64).groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert {r.id: r.n for r in lengths} == {1: pytest.approx(1.0), 2: pytest.approx(1.0)}


def test_intent_udf_equals_brute_force(spark):
    import hashlib
    import math

    from ebbwatch import constants as K

    def counts(text):
        found = {}
        for word in "".join(c if c.isalnum() else " " for c in text.lower()).split():
            bucket = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 4096
            found[bucket] = found.get(bucket, 0) + 1
        return found

    def cos(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(k, 0) for k, x in a.items()) / norm if norm else 0.0

    samples = ["el banco me ha decepcionado", "voy a cerrar todo, voy a cancelar", "gracias, excelente banco", "sin relación alguna"] * 200
    df = spark.createDataFrame(list(enumerate(samples)), "i int, t string")
    got = {r.i: r.s for r in df.select("i", T.lexical_intent_udf()("t").alias("s")).collect()}
    for i, text in enumerate(samples[:4]):
        v = counts(text)
        net = max(cos(v, counts(a)) for a in K.CHURN_ANCHORS) - 0.5 * max(cos(v, counts(a)) for a in K.RETENTION_ANCHORS)
        assert got[i] == got[i + 796] == pytest.approx(min(max(net, 0.0), 1.0), abs=1e-5)


def test_words_are_hashed_once_for_each_batch(spark):
    texts = [None, "", " .,! ", "uno dos UNO ñandú É é 名前 名前 uno2", "a " * 2_500 + "b", "dos", "x\u0000y _z_ \U0001f600 ok"]
    rows = [(i % 6 if i % 5 else None, t) for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "id long, t string").repartition(3)
    for buckets in (7, 4096):
        plain = T.term_counts(docs, "id", "t", buckets)
        for piece in (1, 3, 1_000):
            counted = T.word_counts(docs, "id", "t", buckets, piece)
            assert counted.dtypes == plain.dtypes
            assert sorted(map(repr, counted.collect())) == sorted(map(repr, plain.collect()))
    many = spark.range(0, 5_000, 1, 1).select("id", F.concat_ws(" ", F.lit("w"), F.col("id") % 7, F.col("id")).alias("t"))
    assert T.word_counts(many, "id", "t", 64).exceptAll(T.term_counts(many, "id", "t", 64)).count() == 0
    assert T.word_counts(docs.where("t is null"), "id", "t", 7).count() == 0
    plan = T.text_vectors(docs, "id", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "MapInArrow" in plan
