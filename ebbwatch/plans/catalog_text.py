"""Vectors, similarity, intent and tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions import scalar as S
from ebbwatch.functions import vectors as V
from ebbwatch.operators import scoring as R
from ebbwatch.operators import textual as T
from ebbwatch.plans import oracle as O
from ebbwatch.plans.registry import micro_text, query, silver, six
from ebbwatch.sources.snapshot import complaints
from ebbwatch.sources.storage import read_table, spread

d = O.d
TEXT_DIM = 64  # buckets of a dense text vector


def _documents(spark, folder):
    return spread(read_table(spark, folder, "documents").select("doc_id", "text"))


def _vectors(spark, folder):
    return read_table(spark, folder, "embeddings")


_ANCHORS = f"""ev AS (SELECT vec_id, label, embedding::double[] AS v FROM embeddings),
  cell AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM ev),
  mean AS (SELECT label, pos, avg(x) AS x FROM cell WHERE label IS NOT NULL GROUP BY 1, 2),
  cent AS (SELECT label, list(x ORDER BY pos) AS m FROM mean GROUP BY 1),
  anchors AS (SELECT label AS anchor, CASE WHEN label < 5 THEN 'churn' ELSE 'retention' END AS kind,
    list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS a FROM cent)"""


def _cos(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


_SIM = _ANCHORS + f""",
  sim AS (SELECT vec_id, label, anchor, kind, {_cos('v', 'a')} AS s FROM ev CROSS JOIN anchors),
  best AS (SELECT vec_id, label, max(CASE WHEN kind = 'churn' THEN s END) AS cs, max(CASE WHEN kind = 'retention' THEN s END) AS rs FROM sim GROUP BY 1, 2),
  intent AS (SELECT *, greatest({d('0.0')}, least({d('1.0')}, cs - rs * {d('0.5')})) AS score FROM best)"""


def _micro_list(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: cast(cast(floor(x * 1000000.0::double + 0.5::double) AS bigint) AS varchar)), ',')"


@query(
    "l2_normalize",
    f"""WITH ev AS (SELECT vec_id, list_transform(embedding, lambda x: x::double * 3.0::double) AS v FROM embeddings)
    SELECT vec_id, {_micro_list('list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))')} AS unit FROM ev""",
)
def l2_normalize(spark, folder):
    scaled = F.transform(V.to_double("embedding"), lambda x: x * 3.0)
    return _vectors(spark, folder).select("vec_id", micro_text(V.l2_normalize(scaled)).alias("unit"))


@query(
    "cosine",
    f"""WITH e AS (SELECT vec_id, embedding::double[] AS v FROM embeddings)
    SELECT a.vec_id, {O.six(_cos('a.v', 'b.v'))} AS similarity FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""",
)
def cosine(spark, folder):
    """Each vector against the one with the next key."""
    rows = _vectors(spark, folder).select("vec_id", "embedding")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next_embedding"))
    return rows.join(following, "vec_id").select("vec_id", six(V.cosine("embedding", "next_embedding")).alias("similarity"))


@query("text_x_anchor", f"WITH {_SIM} SELECT vec_id, cast(anchor AS int) AS anchor, kind, {O.six('s')} AS similarity FROM sim")
def text_x_anchor(spark, folder):
    vectors = _vectors(spark, folder)
    pairs = T.text_x_anchor(vectors, T.label_anchors(vectors))
    return pairs.select("vec_id", "anchor", "kind", six("similarity").alias("similarity"))


@query("max_anchor_similarity", f"WITH {_SIM} SELECT vec_id, {O.six('cs')} AS churn_similarity, {O.six('rs')} AS retention_similarity FROM best")
def max_anchor_similarity(spark, folder):
    vectors = _vectors(spark, folder)
    best = T.max_anchor_similarity(vectors, T.label_anchors(vectors))
    return best.select("vec_id", six("churn_similarity").alias("churn_similarity"), six("retention_similarity").alias("retention_similarity"))


@query("churn_intent", f"WITH {_SIM} SELECT vec_id, {O.six('score')} AS churn_intent_score FROM intent")
def churn_intent(spark, folder):
    vectors = _vectors(spark, folder)
    return T.churn_intent(vectors, T.label_anchors(vectors)).select("vec_id", six("churn_intent_score").alias("churn_intent_score"))


_BAND = f"CASE WHEN {{0}} > {d('0.70')} THEN 'ALTO' WHEN {{0}} > {d('0.45')} THEN 'MEDIO' ELSE 'BAJO' END"


@query("similarity_band", f"WITH {_SIM} SELECT vec_id, {O.six('cs')} AS similarity, {_BAND.format(O.six('cs'))} AS riesgo FROM best")
def similarity_band(spark, folder):
    vectors = _vectors(spark, folder)
    best = T.max_anchor_similarity(vectors, T.label_anchors(vectors)).select("vec_id", six("churn_similarity").alias("similarity"))
    return best.withColumn("riesgo", S.band("similarity", K.SIMILARITY_CUTS, K.SIMILARITY_LABELS, closed="right"))


_CENTROID = _ANCHORS + """,
  hcell AS (SELECT unnest(a) AS x, generate_subscripts(a, 1) AS pos FROM anchors WHERE kind = 'churn'),
  hmean AS (SELECT pos, avg(x) AS x FROM hcell GROUP BY 1),
  hm AS (SELECT list(x ORDER BY pos) AS m FROM hmean),
  centre AS (SELECT list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS c FROM hm)"""


def _history(vectors):
    """The history profiles: the centroids of the leaving labels."""
    return T.label_anchors(vectors).where("kind = 'churn'")


@query(
    "centroid",
    """WITH cell AS (SELECT unnest(embedding::double[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings WHERE label < 5),
    mean AS (SELECT pos, avg(x) AS x FROM cell GROUP BY 1), hm AS (SELECT list(x ORDER BY pos) AS m FROM mean)
    SELECT """
    + _micro_list("list_transform(m, lambda x: x / sqrt(list_dot_product(m, m)))")
    + " AS centroid FROM hm",
)
def centroid(spark, folder):
    return T.centroid(_vectors(spark, folder).where("label < 5")).select(micro_text("centroid").alias("centroid"))


@query(
    "centroid_similarity",
    f"""WITH {_CENTROID}, h AS (SELECT vec_id, max({_cos('v', 'a')}) AS ms FROM ev CROSS JOIN anchors WHERE kind = 'churn' GROUP BY 1)
    SELECT ev.vec_id, {O.six(_cos('v', 'c'))} AS centroid_similarity, {O.six('ms')} AS max_similarity FROM ev CROSS JOIN centre JOIN h USING (vec_id)""",
)
def centroid_similarity(spark, folder):
    vectors = _vectors(spark, folder)
    rows = T.centroid_similarity(vectors, _history(vectors))
    return rows.select("vec_id", six("centroid_similarity").alias("centroid_similarity"), six("max_similarity").alias("max_similarity"))


@query("vector_dimension", "SELECT cast(min(len(embedding)) AS int) AS dim, count(*) AS n, min(len(embedding)) = max(len(embedding)) AS agrees FROM embeddings")
def vector_dimension(spark, folder):
    return T.vector_dimension(_vectors(spark, folder))


TEXTS = f"k AS (SELECT {O.COMPLAINT} AS complaint_id, 'CLI-' || lpad(cast(conv_id AS varchar), 7, '0') AS customer_id, text FROM conversations WHERE role = 'user')"


_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: len(w) > 0)"
_BUCKET = "cast(cast('0x' || substr(md5(word), 1, 8) AS bigint) % {n} AS int)"


_ALL = ", ".join(f"({i}, '{kind}', '{a}')" for i, (kind, a) in enumerate([*(("churn", a) for a in K.CHURN_ANCHORS), *(("retention", a) for a in K.RETENTION_ANCHORS)]))


def _counts(name: str, table: str, key: str, n: int) -> str:
    """Hashed word counts of a table of texts, and their lengths."""
    return f"""{name}w AS (SELECT {key}, unnest({_WORDS}) AS word FROM {table}),
  {name} AS (SELECT {key}, {_BUCKET.format(n=n)} AS bucket, count(*)::double AS tf FROM {name}w GROUP BY 1, 2),
  {name}n AS (SELECT {key}, sqrt(sum(tf * tf)) AS length FROM {name} GROUP BY 1)"""


_TEXT_INTENT = f"""{TEXTS}, sentence AS (SELECT * FROM (VALUES {_ALL}) AS x(anchor, kind, text)),
  {_counts('kt', 'k', 'complaint_id', 4096)}, {_counts('sc', 'sentence', 'anchor', 4096)},
  dots AS (SELECT complaint_id, anchor, sum(kt.tf * sc.tf) AS dot FROM kt JOIN sc USING (bucket) GROUP BY 1, 2),
  cosines AS (SELECT complaint_id, kind, dot / (ktn.length * scn.length) AS s FROM dots JOIN ktn USING (complaint_id) JOIN scn USING (anchor) JOIN sentence USING (anchor)),
  tops AS (SELECT complaint_id, coalesce(max(CASE WHEN kind = 'churn' THEN s END), 0.0::double) AS cs, coalesce(max(CASE WHEN kind = 'retention' THEN s END), 0.0::double) AS rs FROM cosines GROUP BY 1),
  tintent AS (SELECT complaint_id, customer_id, text, greatest(0.0::double, least(1.0::double, coalesce(cs, 0.0::double) - coalesce(rs, 0.0::double) * 0.5::double)) AS score FROM k LEFT JOIN tops USING (complaint_id))"""

@query("complaint_intent", f"WITH {_TEXT_INTENT} SELECT complaint_id, customer_id, {O.six('score')} AS churn_intent_score FROM tintent")
def complaint_intent(spark, folder):
    """Net intent of every complaint text against the leaving and staying sentences."""
    texts = complaints(spark, folder)
    scored = T.text_intent(texts, "complaint_id", "complaint_text")
    joined = texts.select("complaint_id", "customer_id").join(scored, "complaint_id", "left")
    return joined.select("complaint_id", "customer_id", six("churn_intent_score").alias("churn_intent_score"))


DENSE = f"""{_counts('vt', 'k', 'complaint_id', TEXT_DIM)},
  slots AS (SELECT complaint_id, customer_id, len(text) AS n_chars, unnest(range(0, {TEXT_DIM})) AS pos FROM k),
  dense AS (SELECT s.complaint_id, customer_id, n_chars, pos, coalesce(tf / length, 0.0::double) AS x FROM slots s
    LEFT JOIN vt ON vt.complaint_id = s.complaint_id AND vt.bucket = s.pos LEFT JOIN vtn ON vtn.complaint_id = s.complaint_id)"""


@query(
    "attach_vectors",
    f"WITH {TEXTS}, {DENSE} SELECT complaint_id, customer_id, max(n_chars) AS n_chars, {_micro_list('list(x ORDER BY pos)')} AS vector FROM dense GROUP BY 1, 2",
)
def attach_vectors(spark, folder):
    """Every complaint with the vector of its text."""
    texts = complaints(spark, folder)
    vectors = T.dense_text_vectors(texts, "complaint_id", "complaint_text", TEXT_DIM)
    rows = T.attach_vectors(texts, vectors, "complaint_id", "complaint_id")
    return rows.select(
        "complaint_id", "customer_id", F.length("complaint_text").cast("bigint").alias("n_chars"), micro_text("embedding").alias("vector")
    )


_CUSTOMER_VECTORS = f"""{_TEXT_INTENT}, {DENSE},
  km AS (SELECT customer_id, pos, avg(x) AS x FROM dense GROUP BY 1, 2),
  ke AS (SELECT customer_id, list(x ORDER BY pos) AS e FROM km GROUP BY 1),
  ki AS (SELECT customer_id, max(score) AS churn_intent_score, count(*) AS n_texts FROM tintent GROUP BY 1)"""


def customer_intent(spark, folder):
    """Mean text vector, highest intent and number of texts of every customer with complaints."""
    rows = T.text_profiles(complaints(spark, folder), ["complaint_id", "customer_id"], "complaint_text", TEXT_DIM)
    return T.customer_embedding(rows, TEXT_DIM)


@query(
    "customer_embedding",
    f"WITH {_CUSTOMER_VECTORS} SELECT customer_id, {_micro_list('e')} AS embedding, {O.six('churn_intent_score')} AS churn_intent_score, n_texts FROM ke JOIN ki USING (customer_id)",
)
def customer_embedding(spark, folder):
    rows = customer_intent(spark, folder)
    return rows.select("customer_id", micro_text("embedding").alias("embedding"), six("churn_intent_score").alias("churn_intent_score"), "n_texts")


@query(
    "join_intent",
    f"WITH {O.SILVER}, {_CUSTOMER_VECTORS} SELECT customer_id, age, region, {O.six('coalesce(churn_intent_score, 0.0::double)')} AS churn_intent_score FROM silver LEFT JOIN ki USING (customer_id)",
)
def join_intent(spark, folder):
    joined = R.join_intent(silver(spark, folder), customer_intent(spark, folder))
    return joined.select("customer_id", "age", "region", six("churn_intent_score").alias("churn_intent_score"))


@query(
    "text_vectors",
    f"""WITH w AS (SELECT doc_id, unnest({_WORDS}) AS word FROM documents),
    tf AS (SELECT doc_id, {_BUCKET.format(n=256)} AS bucket, count(*) AS tf FROM w GROUP BY 1, 2),
    idf AS (SELECT bucket, ln(((SELECT count(*) FROM documents) + {d('1.0')}) / (count(*) + {d('1.0')})) + {d('1.0')} AS idf FROM tf GROUP BY 1),
    x AS (SELECT doc_id, bucket, tf * idf AS w FROM tf JOIN idf USING (bucket)), n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1)
    SELECT doc_id, bucket, {O.six('w / norm')} AS weight FROM x JOIN n USING (doc_id)""",
)
def text_vectors(spark, folder):
    rows = T.text_vectors(_documents(spark, folder), "doc_id", "text", buckets=256)
    return rows.select("doc_id", "bucket", six("weight").alias("weight"))


@query("intent_udf", f"WITH {_TEXT_INTENT} SELECT complaint_id, customer_id, {O.half_up('score', 4)} AS churn_intent_score FROM tintent")
def intent_udf(spark, folder):
    """The UDF surface of the text intent; it computes in single precision, so four digits are compared."""
    intent = T.lexical_intent_udf()
    score = F.floor(intent("complaint_text").cast("double") * 10000.0 + 0.5) / 10000.0
    return complaints(spark, folder).select("complaint_id", "customer_id", score.alias("churn_intent_score"))


@query(
    "token_window",
    f"""WITH t AS (SELECT doc_id, {_WORDS} AS t FROM documents),
    w AS (SELECT doc_id, t, unnest(generate_series(0, greatest(cast(ceil(len(t) / 128.0) AS int), 1) - 1)) AS window_no FROM t),
    p AS (SELECT doc_id, window_no, t[window_no * 128 + 1 : window_no * 128 + 128] AS p FROM w)
    SELECT doc_id, cast(window_no AS int) AS window_no, cast(len(p) AS int) AS n_tokens,
    array_to_string(list_concat(p, list_transform(generate_series(1, 128 - len(p)), lambda i: '[PAD]')), ' ') AS tokens,
    repeat('1', len(p)) || repeat('0', 128 - len(p)) AS mask FROM p""",
)
def token_window(spark, folder):
    rows = T.token_windows(_documents(spark, folder), "doc_id", "text")
    mask = F.array_join(F.transform("mask", lambda x: x.cast("string")), "")
    return rows.select("doc_id", "window_no", "n_tokens", F.array_join("tokens", " ").alias("tokens"), mask.alias("mask"))


@query(
    "mean_pooling",
    f"""WITH w AS (SELECT {O.COMPLAINT} AS complaint_id, unnest({_WORDS}) AS word FROM conversations WHERE role = 'user'),
    tf AS (SELECT complaint_id, cast('0x' || substr(md5(word), 1, 8) AS bigint) % (SELECT max(vec_id) + 1 FROM embeddings) AS bucket, count(*) AS tf FROM w GROUP BY 1, 2),
    c AS (SELECT complaint_id, tf, unnest(embedding::double[]) AS x, generate_subscripts(embedding, 1) AS pos FROM tf JOIN embeddings ON vec_id = bucket),
    m AS (SELECT complaint_id, pos, sum(x * tf) / sum(tf) AS x, cast(sum(tf) AS bigint) AS n_known FROM c GROUP BY 1, 2),
    e AS (SELECT complaint_id, max(n_known) AS n_known, array_to_string(list(cast({O.micro('x')} AS varchar) ORDER BY pos), ',') AS embedding FROM m GROUP BY 1),
    a AS (SELECT {O.COMPLAINT} AS complaint_id, cast(len({_WORDS}) AS bigint) AS n_tokens FROM conversations WHERE role = 'user')
    SELECT complaint_id, n_tokens, coalesce(n_known, 0) AS n_known, embedding FROM a LEFT JOIN e USING (complaint_id)""",
)
def mean_pooling(spark, folder):
    """Complaint vectors as means of token vectors; the embeddings table serves as the token table."""
    tokens = _vectors(spark, folder).select(F.col("vec_id").alias("bucket"), "embedding")
    pooled = T.mean_pooling(complaints(spark, folder), "complaint_id", "complaint_text", tokens)
    vector = F.when(F.col("embedding").isNotNull(), micro_text("embedding"))
    return pooled.select("complaint_id", "n_tokens", "n_known", vector.alias("embedding"))
