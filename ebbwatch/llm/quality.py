"""Quality grades by ordinal cumulative-link regression on hashed text.

Grades 0..K-1 share one weight vector over hashed words and shape marks of a text; ordered thresholds cut its
score: P(grade >= k) = sigmoid(score - threshold[k]). The model is fitted on a bounded sample of rated documents
and scores every document, giving the expected grade and the tail probability that selection uses.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.llm.common import WORD_BYTES, add_by_shard, utf8

BUCKETS = 1 << 17
MAX_RATED = 12_000  # rated documents the model is fitted on
FIELDS = [T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())]
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_MARK = np.isin(np.arange(256), [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-"])


def _shape(text: bytes, words: list[bytes], n_distinct: int) -> list[bytes]:
    """Bucketed marks of the form of a text: length, repetition, case, digits, symbols, word and line lengths."""
    if not words:
        return [b"\0empty"]
    raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters, size = max(1, int(raw[_LETTER].sum())), max(1, len(text))
    tenth = lambda x: int(10 * x)
    marks = (
        ("length", int(np.log2(len(words)))),
        ("distinct", tenth(n_distinct / len(words)), int(np.log2(len(words)))),
        ("upper", tenth(raw[_UPPER].sum() / letters)),
        ("digit", tenth(raw[_DIGIT].sum() / size * 3)),
        ("mark", min(20, int(40 * raw[_MARK].sum() / size))),
        ("word", min(20, int(letters / len(words)))),
        ("line", int(np.log2(size / (1 + raw[10])))),
    )
    return [b"\0" + ":".join(map(str, m)).encode() for m in marks]


def features(text: bytes) -> np.ndarray:
    """Distinct hashed buckets of a whole text."""
    words = text.translate(WORD_BYTES).split()
    distinct = set(words)
    tokens = [*distinct, *_shape(text, words, len(distinct))]
    return np.unique(np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens)) % BUCKETS).astype(np.int32)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, one column each."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -30, 30)))


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, levels: int, rounds: int = 120, penalty: float = 2e-5, rate: float = 0.15
) -> OrdinalModel:
    """Full-batch Adam on the cumulative logits, every grade with equal weight; thresholds stay ordered.

    Each text has unit length: a bucket counts 1 / sqrt(number of buckets). Without texts no weight is known and the
    thresholds lie below every score, so that nothing is told to be bad.
    """
    if not len(rows):
        return OrdinalModel(np.zeros(BUCKETS), np.full(levels - 1, -30.0) + np.arange(levels - 1))
    size = np.array([len(r) for r in rows], np.int64)
    at = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(rows)), size)
    value = np.repeat(1 / np.sqrt(np.maximum(1, size)), size)
    weights, gaps = np.zeros(BUCKETS), np.zeros(levels - 1)
    count = np.maximum(1, np.bincount(grades, minlength=levels))
    per_row = (1 / (levels * count))[grades] if len(grades) else np.zeros(0)
    above = grades[:, None] >= np.arange(1, levels)[None, :]
    state = [np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(levels - 1), np.zeros(levels - 1)]
    for t in range(1, rounds + 1):
        thresholds = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
        score = np.bincount(row, weights[at] * value, minlength=len(rows))
        tail = OrdinalModel(weights, thresholds).tails(score)
        error = (tail - above) * per_row[:, None]
        slope = np.bincount(at, error.sum(axis=1)[row] * value, minlength=BUCKETS) + penalty * weights
        cut = -error.sum(axis=0)
        back = np.cumsum(cut[::-1])[::-1]
        gap_slope = np.concatenate([back[:1], back[1:] * np.exp(gaps[1:])])
        for x, g, i in ((weights, slope, 0), (gaps, gap_slope, 2)):
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 1] = 0.999 * state[i + 1] + 0.001 * g * g
            step = 10 * rate if i == 0 else rate
            x -= step * (state[i] / (1 - 0.9**t)) / (np.sqrt(state[i + 1] / (1 - 0.999**t)) + 1e-8)
    return OrdinalModel(weights, np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])])))


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 for toxic, 1 for low quality, 2 for good text; null where a rating is missing."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(toxic).isNull() | F.col(quality).isNull(), None).otherwise(
        F.when(F.col(quality) == 1, 2).otherwise(1)
    )


def train_grades(
    documents: DataFrame,
    ratings: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    levels: int = 3,
    max_rated: int = MAX_RATED,
    shard_bytes: int = 2_000_000,
) -> OrdinalModel:
    """Fit on the ``max_rated`` rated documents that come first by a hash of their id.

    ``ratings`` has the id column and ``grade``. Ids that are null or rated twice with different grades are left
    out. Of several documents with one id the text with the smallest hash counts, once, so no more than ``max_rated``
    rows reach the driver. Null texts are empty. Without ratings see ``fit_ordinal``; other columns
    are not read.
    """
    rated = (
        ratings.select(F.col(f"`{doc_id}`").alias("rated_id"), "grade")
        .where("rated_id is not null and grade is not null")
        .groupBy("rated_id")
        .agg(F.min("grade").alias("grade"), F.max("grade").alias("top"))
        .where("grade = top")
        .drop("top")
    )
    sample = rated.orderBy(F.xxhash64("rated_id"), "rated_id").limit(max_rated)
    texts = documents.select(F.col(f"`{doc_id}`").alias("rated_id"), F.col(f"`{text}`").alias("text"))
    rows = texts.join(F.broadcast(sample), "rated_id")  # at most max_rated small rows
    chosen = rows.groupBy("rated_id").agg(F.min("grade").alias("grade"), F.min_by("text", F.xxhash64("text")).alias("text"))

    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([features(t or b"") for t in utf8(shard.column("text"))], pa.list_(pa.int32()))]

    field = T.StructField("buckets", T.ArrayType(T.IntegerType()))
    found = add_by_shard(chosen, "text", [field], compute, shard_bytes).select("rated_id", "grade", "buckets")
    table = found.toArrow().sort_by("rated_id")
    rows = [np.asarray(x.values.to_numpy(), np.int32) for x in table.column("buckets")]
    return fit_ordinal(rows, table.column("grade").to_numpy().astype(np.int64), levels)


def add_grades(
    documents: DataFrame, model: OrdinalModel, text: str = "text", tail: int = 1, shard_bytes: int = 2_000_000
) -> DataFrame:
    """``documents`` with ``expected_grade`` and ``tail_probability``, P(grade >= ``tail``), of each whole text.

    Null is an empty text. Repeated rows are scored each and alike. Input columns named like a result are
    replaced. An empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        m = shared.value
        rows = [features(t or b"") for t in utf8(shard.column(text))]
        score = np.array([m.weights[r].sum() / np.sqrt(len(r)) for r in rows])
        tails = m.tails(score)
        return [pa.array(tails.sum(axis=1)), pa.array(tails[:, tail - 1])]

    return add_by_shard(documents, text, FIELDS, compute, shard_bytes)
