"""Vectors, anchors, intent and tokens."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch import constants as K
from ebbwatch.functions import vectors as V
from ebbwatch.functions.texts import words
from ebbwatch.operators.skew import heavy_join

ANCHOR_BYTES = 64_000_000  # of anchor vectors that are sent to the executors at once

# ------------------------------------------------------------------------------- anchors and intent


def common_dimension(df: DataFrame, vector: str = "embedding") -> int:
    """Length of the vectors of a table, read from it; rows that disagree are an error."""
    found = vector_dimension(df.where(F.col(vector).isNotNull()), vector).first()
    if not found.n:
        return 0
    if not found.agrees:
        raise ValueError(f"vectors in {vector!r} differ in length")
    return found.dim


def label_anchors(vectors: DataFrame, churn_labels: int = 5) -> DataFrame:
    """Anchor table (anchor, kind, vector): the centroid of each label, leaving labels first; null is no label."""
    kind = F.when(F.col("label") < churn_labels, "churn").otherwise("retention")
    return (
        vectors.where("label is not null")
        .groupBy("label")
        .agg(V.mean_of_dimensions("embedding", common_dimension(vectors)).alias("vector"))
        .select(F.col("label").cast("int").alias("anchor"), kind.alias("kind"), V.l2_normalize("vector").alias("vector"))
    )


class AnchorBlock:
    """Unit vectors of some anchors, ordered by their angle to a middle direction, for the highest cosine to one."""

    SIZE = 1_024

    def __init__(self, vectors: np.ndarray):
        unit = _unit_rows(vectors)
        zero = ~unit.any(axis=1)
        self.any, self.zero, unit = len(unit) > 0, bool(zero.any()), unit[~zero]
        middle = unit.sum(axis=0, keepdims=True) if len(unit) else np.zeros((1, unit.shape[1]))
        self.middle = _unit_rows(middle)[0]
        angle = np.arccos(np.clip(unit @ self.middle, -1, 1))
        order = np.argsort(angle, kind="stable")
        self.parts = [
            (float(angle[o].min()), float(angle[o].max()), np.ascontiguousarray(unit[o].T))
            for o in (order[i : i + self.SIZE] for i in range(0, len(order), self.SIZE))
        ]

    def highest(self, unit: np.ndarray) -> np.ndarray:
        """The highest cosine of each row to an anchor; minus infinity without anchors.

        The angle between a row and the anchors of a part is at least the gap between their angles to the middle, so a
        part whose bound a row has reached is not multiplied with it.
        """
        zero = ~unit.any(axis=1)
        best = np.full(len(unit), -np.inf)
        best[zero] = 0.0 if self.any else -np.inf
        if self.zero:
            best[:] = 0.0
        angle = np.arccos(np.clip(unit @ self.middle, -1, 1))
        for low, high, part in self.parts:
            gap = np.maximum(0, np.maximum(low - angle, angle - high))
            open_ = np.flatnonzero(~zero & (np.cos(gap) + 1e-9 > best))
            if len(open_):
                best[open_] = np.maximum(best[open_], (unit[open_] @ part).max(axis=1))
        return best


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows and rows that are not numbers are zero."""
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows, dtype=float), where=norm > 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column; a null vector is zero, one of another length an error."""
    if not dim:  # there are no anchors
        return np.zeros((len(column), 0))
    known = column.is_valid().to_numpy(zero_copy_only=False)
    found = column.drop_null()
    lengths = pc.list_value_length(found).to_numpy(zero_copy_only=False)
    if len(lengths) and not (lengths == dim).all():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()))[:3]} entries meet anchors of {dim}")
    out = np.zeros((len(column), dim))
    out[known] = found.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    return out


def _anchor_blocks(anchors: DataFrame, block: int | None = None) -> tuple[int, list[DataFrame]]:
    """Dimension, and the anchors in frames of at most about ANCHOR_BYTES, or ``block`` rows."""
    shape = vector_dimension(anchors.where("vector is not null"), "vector").first()
    if shape.n and not shape.agrees:
        raise ValueError("anchors differ in length")
    dim = shape.dim if shape.n else 0
    block = block or max(1, ANCHOR_BYTES // (8 * max(1, dim)))
    count = max(1, -(-shape.n // block))
    number = F.pmod(F.xxhash64("anchor", "kind"), F.lit(count))
    return dim, [anchors if count == 1 else anchors.where(number == i) for i in range(count)]


def _send(block: DataFrame, dim: int):
    """The anchors of a block, ordered, as a broadcast of (numbers, kinds, unit vectors)."""
    table = block.select("anchor", "kind", V.to_double("vector").alias("vector")).toArrow().sort_by([("anchor", "ascending"), ("kind", "ascending")])
    vectors = _unit_rows(_matrix(table.column("vector").combine_chunks(), dim))
    return block.sparkSession.sparkContext.broadcast((table.column("anchor").combine_chunks(), table.column("kind").combine_chunks(), vectors))


def text_x_anchor(vectors: DataFrame, anchors: DataFrame, vector: str = "embedding", block: int | None = None) -> DataFrame:
    """Cosine of every vector to every anchor, one row for each: a matrix product for each batch and block of anchors.

    No join takes place and no row carries anchors along. Anchors beyond one block take a pass over the vectors each.
    """
    dim, blocks = _anchor_blocks(anchors, block)
    kept = [f for f in vectors.schema.fields if f.name != vector]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = f"{kinds + ', ' if kinds else ''}anchor int, kind string, similarity double"
    rows = vectors.withColumn(vector, V.to_double(vector))

    def unfold(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, names, unit = sent.value
            step = max(1, 200_000 // max(1, len(unit)))
            for batch in batches:
                for at in range(0, batch.num_rows if len(unit) else 0, step):
                    part = batch.slice(at, step)
                    found = _unit_rows(_matrix(part.column(vector), dim)) @ unit.T
                    row = pa.array(np.repeat(np.arange(part.num_rows), len(unit)))
                    which = pa.array(np.tile(np.arange(len(unit)), part.num_rows))
                    columns = [part.column(f.name).take(row) for f in kept]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, numbers.take(which), names.take(which), pa.array(found.ravel())],
                        [*[f.name for f in kept], "anchor", "kind", "similarity"],
                    )

        return run

    pairs = [rows.mapInArrow(unfold(_send(b, dim)), schema) for b in blocks]
    return functools.reduce(DataFrame.union, pairs)


def _add_highest(vectors: DataFrame, anchors: DataFrame, vector: str, wanted: Mapping[str, str | None], block: int | None) -> DataFrame:
    """Adds a column for each wanted kind (None: any): the highest cosine to its anchors, null without any."""
    dim, blocks = _anchor_blocks(anchors, block)
    names = [f"_highest_{i}" for i in range(len(wanted))]
    rows = vectors.withColumn("_unit", V.to_double(vector))
    carried = rows.columns
    fields = T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def add(sent, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, kinds, unit = sent.value
            kinds = np.array(kinds.to_pylist(), object)
            sets = [AnchorBlock(unit if k is None else unit[kinds == k]) for k in wanted.values()]
            for batch in batches:
                found = _unit_rows(_matrix(batch.column("_unit"), dim))
                best = [s.highest(found) for s in sets]
                if not first:
                    best = [np.maximum(b, batch.column(n).to_numpy()) for b, n in zip(best, names, strict=True)]
                given = [batch.column(c) for c in carried]
                yield pa.RecordBatch.from_arrays([*given, *map(pa.array, best)], fields.names)

        return run

    found = rows
    for i, b in enumerate(blocks):
        found = found.mapInArrow(add(_send(b, dim), i == 0), fields)
    told = {name: F.when(F.col(n) > float("-inf"), F.col(n)) for name, n in zip(wanted, names, strict=True)}
    return found.withColumns(told).drop("_unit", *names)


def max_anchor_similarity(vectors: DataFrame, anchors: DataFrame, vector: str = "embedding", block: int | None = None) -> DataFrame:
    """Adds the highest similarity to the leaving and to the staying anchors; null without any."""
    return _add_highest(vectors, anchors, vector, {"churn_similarity": "churn", "retention_similarity": "retention"}, block)


def churn_intent(vectors: DataFrame, anchors: DataFrame, vector: str = "embedding") -> DataFrame:
    scored = max_anchor_similarity(vectors, anchors, vector)
    net = V.net_intent(F.col("churn_similarity"), F.col("retention_similarity"), K.RETENTION_DISCOUNT)
    return scored.withColumn("churn_intent_score", net)


def attach_vectors(texts: DataFrame, vectors: DataFrame, text_key: str, vector_key: str) -> DataFrame:
    """All texts with their vectors, joined on the key and never by position; null where a text has none."""
    keyed = vectors.select(F.col(vector_key).alias(text_key), "embedding")
    return texts.join(keyed, text_key, "left")


# --------------------------------------------------------------------------------- intent of texts


def _sentence_cells(spark, churn_anchors: Sequence[str], retention_anchors: Sequence[str], buckets: int) -> tuple[DataFrame, list[int]]:
    """(bucket, units): the share of each sentence in a bucket of words; and the kind of each sentence, 0 or 1.

    The words of the sentences are a table fixed by its definition.
    """
    sentences = [*((a, 0) for a in churn_anchors), *((a, 1) for a in retention_anchors)]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(sentences)], "anchor int, sentence string")
    cells = term_counts(frame, "anchor", "sentence", buckets)
    length = cells.groupBy("anchor").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("length"))
    units = cells.join(length, "anchor").select("anchor", "bucket", (F.col("tf") / F.col("length")).alias("unit"))
    per_bucket = units.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("anchor", "unit"))).alias("units"))
    return per_bucket, [kind for _, kind in sentences]


def _intent_columns(kinds: Sequence[int]) -> tuple[list[Column], Column, Column, Column]:
    """Sums of an aggregate over (tf, units), and from them the similarities to both kinds and the net intent."""
    dots = [F.sum(F.col("tf") * F.coalesce(F.col("units")[i], F.lit(0.0))).alias(f"dot{i}") for i in range(len(kinds))]

    def best(kind: int) -> Column:
        found = [F.col(f"dot{i}") / F.col("length") for i, k in enumerate(kinds) if k == kind]
        return F.when(F.col("length") > 0, F.array_max(F.array(*found, F.lit(0.0)))).otherwise(0.0)

    sums = [F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("length"), *dots]
    return sums, best(0), best(1), V.net_intent(best(0), best(1), K.RETENTION_DISCOUNT)


def text_intent(
    texts: DataFrame,
    key: str,
    text: str,
    churn_anchors: Sequence[str] = K.CHURN_ANCHORS,
    retention_anchors: Sequence[str] = K.RETENTION_ANCHORS,
    buckets: int = 4096,
) -> DataFrame:
    """(key, churn_similarity, retention_similarity, churn_intent_score) for every text.

    Texts and anchor sentences are vectors of hashed word counts; the highest cosine to each kind of sentence gives
    the net intent. A text without words has similarity 0.
    """
    per_bucket, kinds = _sentence_cells(texts.sparkSession, churn_anchors, retention_anchors, buckets)
    counts = term_counts(texts, key, text, buckets).join(F.broadcast(per_bucket), "bucket", "left")
    sums, leave, stay, net = _intent_columns(kinds)
    scored = counts.groupBy(F.col(key).alias("_of")).agg(*sums)
    joined = texts.select(key).join(scored, F.col(key).eqNullSafe(F.col("_of")), "left")
    return joined.select(
        key, leave.alias("churn_similarity"), stay.alias("retention_similarity"), net.alias("churn_intent_score")
    )


def text_profiles(
    texts: DataFrame,
    keys: Sequence[str],
    text: str,
    dim: int,
    churn_anchors: Sequence[str] = K.CHURN_ANCHORS,
    retention_anchors: Sequence[str] = K.RETENTION_ANCHORS,
    buckets: int = 4096,
) -> DataFrame:
    """(keys, embedding, churn_intent_score): what ``dense_text_vectors`` and ``text_intent`` tell, from one count of words.

    ``dim`` divides ``buckets``, so the bucket of the vector follows from that of the intent. Texts that agree in all
    keys are one text; one without words has a zero vector and intent 0.
    """
    if buckets % dim:
        raise ValueError("the dimension has to divide the buckets")
    per_bucket, kinds = _sentence_cells(texts.sparkSession, churn_anchors, retention_anchors, buckets)
    tokens = texts.select(*keys, F.explode_outer(words(text)).alias("word"))
    counts = tokens.groupBy(*keys, word_bucket(F.col("word"), buckets).alias("bucket")).agg(F.count("word").alias("tf"))
    joined = counts.join(F.broadcast(per_bucket), "bucket", "left")
    dots = [f"dot{i}" for i in range(len(kinds))]
    sums, _, _, net = _intent_columns(kinds)
    # First the cells of the vector, dim at most for each text, then the texts: few sums side by side.
    squares, shares = F.sum(F.col("tf") * F.col("tf")).alias("squares"), sums[1:]
    cells = joined.groupBy(*keys, (F.col("bucket") % dim).alias("cell")).agg(F.sum("tf").alias("n"), squares, *shares)
    summed = cells.groupBy(*keys).agg(
        F.sqrt(F.sum("squares")).alias("length"),
        *[F.sum(d).alias(d) for d in dots],
        F.map_from_entries(F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("cell", "n")))).alias("cells"),
    )
    cell = lambda i: F.coalesce(F.try_element_at("cells", i.cast("int")).cast("double"), F.lit(0.0))
    vector = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), cell)
    named = summed.select(*keys, vector.alias("_v"), net.alias("churn_intent_score"))
    return named.select(*keys, V.l2_normalize("_v").alias("embedding"), "churn_intent_score")


def dense_text_vectors(texts: DataFrame, key: str, text: str, dim: int = 64) -> DataFrame:
    """(key, embedding): hashed word counts of each text in ``dim`` buckets, of unit length; no words give zeros."""
    packed = (
        term_counts(texts, key, text, dim)
        .groupBy(key)
        .agg(
            F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("length"),
            F.map_from_entries(F.collect_list(F.struct("bucket", "tf"))).alias("cells"),  # dim entries at most
        )
        .withColumnRenamed(key, "_of")
    )
    joined = texts.select(key).join(packed, F.col(key).eqNullSafe(F.col("_of")), "left")
    cell = lambda i: F.coalesce(F.col("cells")[i.cast("int")] / F.col("length"), F.lit(0.0))
    return joined.select(key, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), cell).alias("embedding"))


def customer_embedding(texts: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Mean vector and highest intent per customer."""
    return texts.groupBy("customer_id").agg(
        V.mean_of_dimensions(vector, dim).alias("embedding"),
        F.max("churn_intent_score").alias("churn_intent_score"),
        F.count("*").alias("n_texts"),
    )


def centroid(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Re-normalised mean vector of a history, one row."""
    dim = common_dimension(vectors, vector)
    return vectors.agg(V.mean_of_dimensions(vector, dim).alias("m")).select(V.l2_normalize("m").alias("centroid"))


def centroid_similarity(vectors: DataFrame, history: DataFrame, vector: str = "embedding") -> DataFrame:
    """Cosine to the centroid of the history profiles, an anchor table, and the highest cosine to one of them."""
    middle = centroid(history, "vector")
    rows = _add_highest(vectors, history, vector, {"max_similarity": None}, None).withColumn("_c", middle.scalar())
    kept = [c for c in vectors.columns if c not in ("centroid_similarity", "max_similarity")]
    return rows.select(*kept, V.cosine(vector, "_c").alias("centroid_similarity"), "max_similarity")


def vector_dimension(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Dimension of the vectors and whether all rows agree on it."""
    n = F.size(vector)
    return df.agg(F.min(n).alias("dim"), F.max(n).alias("max_dim"), F.count("*").alias("n")).select(
        "dim", "n", (F.col("dim") == F.col("max_dim")).alias("agrees")
    )


# ----------------------------------------------------------------------------------- lexical vectors


def word_bucket(word: Column, buckets: int) -> Column:
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def term_counts(docs: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """Occurrences of each hashed word per document (key, bucket, tf).

    A document lives in one task, so the count is finished by the partial aggregate and the shuffle
    carries one row for each distinct bucket.
    """
    tokens = docs.select(key, F.explode(words(text)).alias("word"))
    return tokens.groupBy(key, word_bucket(F.col("word"), buckets).alias("bucket")).agg(F.count("*").alias("tf"))


def word_counts(docs: DataFrame, key: str, text: str, buckets: int, piece: int = 1_000) -> DataFrame:
    """What ``term_counts`` tells, for long texts: a word is hashed once for each batch of rows, not wherever it stands.

    Texts go to the tasks in pieces of words, which bounds the batches.
    """
    n_pieces = F.ceil(F.size("_t") / piece).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n_pieces - 1), lambda i: F.slice("_t", i * piece + 1, piece))
    pieces = docs.select(key, words(text).alias("_t")).select(key, F.explode(F.when(F.size("_t") > 0, cut)).alias("_words"))
    schema = T.StructType([docs.schema[key], T.StructField("bucket", T.IntegerType()), T.StructField("tf", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):  # bounds the words that are held
                batch = whole.slice(at, 2_000)
                lists = batch.column("_words")
                coded = lists.flatten().dictionary_encode()
                hashed = [int(hashlib.md5(w).hexdigest()[:8], 16) % buckets for w in coded.dictionary.cast(pa.binary()).to_pylist()]
                row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
                cells = row * buckets + np.array(hashed, np.int64)[coded.indices.to_numpy()]
                cell, tf = np.unique(cells, return_counts=True)
                columns = [batch.column(key).take(pa.array(cell // buckets)), pa.array((cell % buckets).astype(np.int32)), pa.array(tf)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return pieces.mapInArrow(count, schema).groupBy(key, "bucket").agg(F.sum("tf").alias("tf"))


def text_vectors(docs: DataFrame, key: str, text: str, buckets: int = 256) -> DataFrame:
    """Hashed TF-IDF as sparse rows (key, bucket, weight), each document of unit length.

    This is lexical: it compares words, not meaning. The idf table has at most ``buckets`` rows.
    """
    counts = word_counts(docs, key, text, buckets)
    n_docs = docs.agg(F.count("*")).scalar()
    # counting through tf keeps both uses of `counts` identical, so its shuffle is made once
    idf = counts.groupBy("bucket").agg(F.count_if(F.col("tf") > 0).alias("df")).select(
        "bucket", (F.ln((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")
    )
    weighted = counts.join(F.broadcast(idf), "bucket").select(key, "bucket", (F.col("tf") * F.col("idf")).alias("w"))
    # one document holds at most `buckets` rows
    packed = weighted.groupBy(key).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.struct("bucket", "w")).alias("cells")
    )
    return packed.select(key, "norm", F.inline("cells")).select(key, "bucket", (F.col("w") / F.col("norm")).alias("weight"))


def token_windows(docs: DataFrame, key: str, text: str, size: int = K.TOKEN_WINDOW, pad: str = "[PAD]") -> DataFrame:
    """Lower-case tokens in windows of ``size``, padded, with mask and length.

    The whole text is covered. Window 0 is what a model with that input length sees.
    """
    tokens = docs.select(key, words(text).alias("_t"))
    n_windows = F.greatest(F.ceil(F.size("_t") / size), F.lit(1)).cast("int")
    # cut first, then unfold: a window carries its own tokens and not those of the whole text
    cut = F.transform(F.sequence(F.lit(0), n_windows - 1), lambda i: F.slice("_t", i * size + 1, size))
    part = tokens.select(key, F.posexplode(cut).alias("window_no", "_p"))
    return part.select(
        key,
        "window_no",
        F.size("_p").alias("n_tokens"),
        F.concat("_p", F.array_repeat(F.lit(pad), F.lit(size) - F.size("_p"))).alias("tokens"),
        F.concat(
            F.array_repeat(F.lit(1), F.size("_p")), F.array_repeat(F.lit(0), F.lit(size) - F.size("_p"))
        ).alias("mask"),
    )


def mean_pooling(docs: DataFrame, key: str, text: str, token_vectors: DataFrame) -> DataFrame:
    """Mean of the token vectors of a document, tokens mapped to a table of bucket vectors (bucket, embedding).

    Every document is reported with all its tokens, and with those whose bucket has a vector, over which the mean
    goes; it is null when there are none. Counts per (document, bucket) weight the mean, so a word is one row of
    a document. A small table of vectors is broadcast; beyond ANCHOR_BYTES the rows of frequent words are dealt over
    many tasks.
    """
    dim = common_dimension(token_vectors)
    shape = token_vectors.agg((F.max("bucket") + 1).alias("n"), F.count("*").alias("rows")).first()
    buckets = F.lit(shape.n)
    tokens = docs.select(key, F.explode_outer(words(text)).alias("word"))
    bucket = (F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint") % buckets).cast("bigint")
    counts = tokens.groupBy(key, bucket.alias("bucket")).agg(F.count("word").alias("tf"))
    if 8 * dim * shape.rows <= ANCHOR_BYTES:
        joined = counts.join(F.broadcast(token_vectors), "bucket", "left")
    else:
        joined = heavy_join(counts, token_vectors, ["bucket"], how="left")
    known = F.when(F.col("embedding").isNotNull(), F.col("tf"))
    sums = [F.sum(F.get("embedding", F.lit(i)).cast("double") * F.col("tf")) for i in range(dim)]
    pooled = joined.groupBy(key).agg(
        F.sum("tf").alias("n_tokens"), F.coalesce(F.sum(known), F.lit(0)).alias("n_known"), F.array(*sums).alias("_s")
    )
    mean = F.when(F.col("n_known") > 0, F.transform("_s", lambda x: x / F.col("n_known")))
    return pooled.select(key, "n_tokens", "n_known", mean.alias("embedding"))


# --------------------------------------------------------------------------------------- UDF surface


def lexical_intent_udf(
    churn_anchors: Sequence[str] = K.CHURN_ANCHORS,
    retention_anchors: Sequence[str] = K.RETENTION_ANCHORS,
    buckets: int = 4096,
):
    """Pandas UDF text -> intent, on hashed word counts.

    The anchors are turned into a matrix once, here, and travel with the closure; texts stay sparse, and a word is
    hashed once for each worker.
    """
    import re

    splitter = re.compile(r"[^\w]+|_+", re.UNICODE)
    known: dict[str, int] = {}

    def cells(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, bucket and count of the different words of some texts."""
        found = [[w for w in splitter.split((t or "").lower()) if w] for t in texts]
        if len(known) > 200_000:
            known.clear()
        for word in {w for ws in found for w in ws}.difference(known):
            known[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % buckets
        row = np.repeat(np.arange(len(found)), [len(ws) for ws in found])
        bucket = np.fromiter((known[w] for ws in found for w in ws), np.int64, len(row))
        cell, count = np.unique(row * buckets + bucket, return_counts=True)
        return cell // buckets, cell % buckets, count.astype(np.float32)

    def embed(texts) -> np.ndarray:
        matrix = np.zeros((len(texts), buckets), dtype=np.float32)
        row, bucket, count = cells(texts)
        matrix[row, bucket] = count
        norm = np.linalg.norm(matrix, axis=1, keepdims=True)
        return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)

    anchors = np.concatenate([embed(churn_anchors), embed(retention_anchors)]).T
    known.clear()  # it travels with the closure
    leaving = len(churn_anchors)

    def similarities(texts) -> np.ndarray:
        row, bucket, count = cells(texts)
        dots = np.zeros((len(texts), anchors.shape[1]), np.float32)
        np.add.at(dots, row, count[:, None] * anchors[bucket])
        norm = np.sqrt(np.bincount(row, count * count, minlength=len(texts)))[:, None]
        return np.divide(dots, norm, out=np.zeros_like(dots), where=norm > 0)

    @F.pandas_udf("float")
    def intent(texts: pd.Series) -> pd.Series:
        scores = []
        for start in range(0, len(texts), 512):  # bounds the words that are held
            found = similarities(texts.iloc[start : start + 512].tolist())
            net = found[:, :leaving].max(axis=1) - K.RETENTION_DISCOUNT * found[:, leaving:].max(axis=1)
            scores.append(np.clip(net, 0.0, 1.0))
        joined = np.concatenate(scores) if scores else np.zeros(0)
        return pd.Series(joined.astype(np.float32))

    return intent
