"""The queries of the corpus operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm import (
    chat, decontaminate, licenses, mixing, packing, periods, quality, secrets, simhash, tokens, trie, urls, vectors,
)
from ebbwatch.llm.sql import ORACLES
from ebbwatch.sources.storage import materialize, read_table

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_path() -> str:
    """Where the vocabulary file lies; the package of public tokenizers is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(
        read_table(spark, folder, "documents").select("doc_id", "text"), read_table(spark, folder, "benchmark")
    )
    hits = decontaminate.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[secrets.count_kind(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(secrets.listed(base_only=True), 256).alias("base_sha256"),
        secrets.listed().alias("spans"),
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    # Longer documents are likelier: by the whole root of their words.
    mixed = mixing.mix_sources(read_table(spark, folder, "documents"), weight=F.floor(F.sqrt("size")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    grouped = simhash.group_near_copies(read_table(spark, folder, "documents"))
    return grouped.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    formatted = materialize(chat.format_conversations(given.unionByName(added)), "chat")
    return formatted.select("conv_id", "formatted", chat.read_turns().alias("turns"), chat.loss_text().alias("loss")).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), ""
            ),
            256,
        ).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


#: Documents whose probability of the best grade is below this are rejected.
KEEP_AT = 0.4


def grade_model(spark: SparkSession, documents: DataFrame, folder: str) -> quality.OrdinalModel:
    ratings = read_table(spark, folder, "labels").select("doc_id", quality.grade().alias("grade"))
    return quality.train_grades(documents, ratings)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.add_grades(documents, grade_model(spark, documents, folder), tail=2)
    return scored.select(
        "doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= KEEP_AT).alias("kept")
    )


def op8_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(read_table(spark, folder, "documents"), tokenizer_path())


def op9_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.link_vectors(read_table(spark, folder, "embeddings"))


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    judged = urls.judge_urls(pages, urls.rule_frame(spark), urls.host_frame(spark), urls.mirrored_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = trie.read_turns(read_table(spark, folder, "conversations"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    rebuilt = trie.rebuild(turns, base=F.col("conv_id") - F.col("conv_id") % 20, shared=shared, most_shared=3)
    built = trie.build_trie(rebuilt)
    joined = built.nodes.join(trie.end_digests(built.ends), trie.PREFIX, "left")
    return joined.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        *["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"],
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.read_pieces(packing.pack_documents(read_table(spark, folder, "documents"), tokenizer_path()))


def with_periods(documents: DataFrame) -> DataFrame:
    """doc_id and text, in which one document in ten repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")).otherwise(F.lit(""))

    # The words are bound once, as the variable of a transform.
    changed = F.element_at(F.transform(F.array(split), repeated), 1)
    return documents.select("doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def op13_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.find_runs(with_periods(read_table(spark, folder, "documents").select("doc_id", "text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.select("doc_id", "runs", "collapsed", periods.longest_run().alias("best"), lines.alias("lines"))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{n}").alias(n) for n in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_licenses, op3_secrets, op4_mixing, op5_simhash,
        op6_chat, op7_quality, op8_tokens, op9_vectors, op10_urls,
        op11_trie, op12_packing, op13_periods,
    )
}
