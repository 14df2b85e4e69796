"""From raw documents to token files: each stage works on all that the one before it kept.

A stage calls its operator on the documents under neutral column names, so columns of any name pass through
untouched. Null and empty texts are documents; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbwatch.llm import decontaminate, mixing, quality, simhash, tokens
from ebbwatch.llm.queries import KEEP_AT, grade_model, tokenizer_path
from ebbwatch.sources.storage import materialize, read_table

ORACLE_SQL = None  # the classifier, the fingerprints and the tokenizer have no SQL


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under neutral column names, and which name each column has."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(short).alias(name) for name, short in names.items()])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier does not reject.

    It is fitted on the rated documents among ``docs``; without any nothing is known and all documents stay. Repeated
    rows are judged alike, rows with a null id by their text like any other.
    """
    model = grade_model(spark, docs, sf_dir)
    rows, names = _aside(docs)
    return _back(quality.add_grades(rows, model, names["text"], tail=2).where(F.col("tail_probability") >= KEEP_AT), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, at most 3 bits apart.

    The smallest id of a group stays; a null id only where there is no other. Of repeated rows one stays.
    """
    rows, names = _aside(docs)
    return _back(simhash.keep_one_of_each(rows, names["doc_id"], names["text"], bits=3, shingle=3), names)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items; one of which no word is left goes.

    ``n_chars`` follows the text, where there is such a column. Repeated rows are cut alike.
    """
    rows, names = _aside(docs)
    cut = decontaminate.remove_contamination(rows, read_table(spark, sf_dir, "benchmark"), names["text"])
    if "n_chars" in names:
        size = F.length(names["text"]).cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn(names["n_chars"], F.when(F.col("words_removed") > 0, size).otherwise(F.col(names["n_chars"])))
    return _back(cut, names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them; a document taken twice is two rows.

    A null source is a source. Rows of one id and text are told apart by a number: as many as there are take what the
    mix gave them. Documents without words are taken for nothing and go.
    """
    mixed = mixing.mix_sources(docs).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("copies").alias("_copies"))
    rows, names = _aside(docs)
    marked = rows.withColumn("_text", F.xxhash64(names["text"]))
    numbered = mixed.withColumn("_of", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.desc("_copies"))))
    number = F.row_number().over(Window.partitionBy(names["doc_id"], "_text").orderBy("_text"))
    joined = marked.withColumn("_no", number).join(
        numbered.where("_copies > 0"),
        F.col(names["doc_id"]).eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")) & (F.col("_no") == F.col("_of")),
    )
    return _back(joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))), names)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32.

    Ids ascend, null first; rows with one id follow a hash of their text. A null text is the end id alone.
    """
    return tokens.encode_corpus(docs, tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("mixing to target weights", mix),
    ("token ids", write_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
