"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Each source gets a target in words. Of a source whose target is r times its size every document is taken
floor(r) times for certain; the fraction left is the inclusion probability of one more copy. Documents are
ranked by the odds of their random number divided by the odds of their inclusion, and the sample is the head
of that order that fills the words left, closed by the one document that fits the rest best.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.sources.storage import materialize

WEIGHTS = (3.0, 1.0, 2.0)
FEW_SOURCES = 10_000  # up to so many, what there is one row of for each source is broadcast
_SPACE = "[\\x20\\x09-\\x0D]+"


def count_words(text: str) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    squeezed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _SPACE, " ")
    bare = F.trim(squeezed)
    return F.when(bare == "", 0).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def uniform(seed: int, *keys: str) -> Column:
    """A number inside (0, 1) that depends on the keys alone: 52 bits of an MD5."""
    joined = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_targets(
    sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS
) -> DataFrame:
    """source, source_size, n_docs, target for frames of (source, size).

    ``share`` times all words are dealt to the sources by weight; a target stops at ``most`` times the size of its
    source and what is over is dealt to the others by weight. Sources take the weights in turn by code point, null
    last. The windows run over one row for each source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    placed = per_source.withColumn(
        "weight", F.element_at(turn, (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ).withColumn("cap", most * F.col("source_size"))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    none = F.lit(0.0)
    level = placed.select(
        "*",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), none)).alias("words"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), none)).alias("weights"),
    ).withColumn("level", F.col("words") / F.col("weights"))
    full = F.col("cap") <= F.col("level") * F.col("weight")
    # Once a source is not full, none after it is: the level of the first such source holds for all of them.
    first = F.min(F.when(~full, F.struct("cap_rank", "level"))).over(everything)["level"]
    ranked = level.withColumn("cap_rank", F.row_number().over(fill))
    return ranked.select(
        "source", "source_size", "n_docs", F.when(full, F.col("cap")).otherwise(first * F.col("weight")).alias("target")
    )


def mix_sources(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | Column | None = None,
    share: float = 1.5,
    most: float = 2.0,
    weights: Sequence[float] = WEIGHTS,
    seed: int = 42,
    rows_per_bucket: int = 5_000,
) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, copies, taken: one row for each document.

    ``copies`` is how often the mix takes the document, ``taken`` the words. ``weight`` may name a column, or be an
    expression over ``size``, in proportion to which documents of a source are included: with weights w the share left
    of a source is taken with probability share * w / (mean of w over its words), below 1. The order of a source is cut in buckets of about
    ``rows_per_bucket`` rows, whatever the source's share of the rows: bucket sums are cumulated, and only the
    bucket in which the words run out is ordered row by row. Which documents are taken depends on the ids and the
    seed alone, so reruns agree.

    Null texts have size 0 and are taken for nothing: sources without words have target 0. A null source is a
    source, null ids are hashed as empty, repeated rows tie and are told apart by their text only. Null weights
    count 1. An empty table gives an empty result; other columns are not read.
    """
    most_copies = int(most)
    given = F.col(f"`{weight}`").cast("double") if isinstance(weight, str) else F.lit(1.0)
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.xxhash64(f"`{text}`").alias("text_hash"),
        count_words(f"`{text}`").alias("size"),
        F.coalesce(given, F.lit(1.0)).alias("weight"),
    )
    if isinstance(weight, Column):
        rows = rows.withColumn("weight", F.coalesce(weight.cast("double"), F.lit(1.0)))
    rows = materialize(rows, "mix-sizes")
    targets = source_targets(rows.select("source", "size"), share, most, weights)
    means = rows.groupBy(F.col("source").alias("mean_of")).agg(
        F.try_divide(F.sum(F.col("weight") * F.col("size")), F.sum("size")).alias("mean_weight")
    )
    targets = materialize(targets.join(means, F.col("source").eqNullSafe(F.col("mean_of"))).drop("mean_of"), "mix-targets")
    few = F.broadcast if targets.count() <= FEW_SOURCES else lambda frame: frame  # one row for each source
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(
        F.col("source").alias("of"), "source_size", "n_docs", "target", "mean_weight", F.least(F.floor(ratio), F.lit(most_copies)).alias("whole")
    ).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    u = uniform(seed, "doc_id")
    share_left = F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0)
    relative = F.coalesce(F.try_divide(F.col("weight"), F.col("mean_weight")), F.lit(1.0))
    p = F.greatest(F.lit(1e-9), share_left * relative)
    usual = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), share_left))
    # Documents that are certain to be included stand before all others, by their random number alone.
    odds = F.when(p >= 1 - 1e-9, u - 1).otherwise((u / (1 - u)) * (usual / (1 - usual)) / (p / (1 - p)))
    buckets = F.ceil(F.col("n_docs") / rows_per_bucket)
    bucket = F.floor(F.when(F.col("odds") < 0, F.col("odds")).otherwise(F.col("odds") / (1 + F.col("odds"))) * buckets)
    ordered = (
        rows.join(few(targets), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("odds", odds)
        .withColumn("bucket", bucket.cast("bigint"))
        .drop("mean_weight")
    )
    ordered = materialize(ordered, "mix-order")
    sums = ordered.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("of"),
        F.col("bucket").alias("in_bucket"),
        F.coalesce(F.sum("words").over(running), F.lit(0)).alias("bucket_before"),
        F.col("words").alias("bucket_words"),
    )
    ordered = ordered.join(
        sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in_bucket"))
    ).drop("of", "in_bucket")
    inside = Window.partitionBy("source", "bucket").orderBy("odds", "doc_id", "text_hash", "size")
    cut = (F.col("bucket_before") <= F.col("rest")) & (F.col("bucket_before") + F.col("bucket_words") > F.col("rest"))
    within = (
        ordered.where(cut)
        .withColumn("upto", F.col("bucket_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("more", (F.col("upto") <= F.col("rest")).cast("int"))
        .drop("upto")
    )
    outside = ordered.where(~cut).withColumn("more", (F.col("bucket_before") + F.col("bucket_words") <= F.col("rest")).cast("int"))
    headed = within.unionByName(outside)
    headed = materialize(headed.drop("bucket_before", "bucket_words"), "mix-head")
    return _close_gap(headed, few)


def _close_gap(headed: DataFrame, few) -> DataFrame:
    """Add the one document of each source, after the head of the order, whose size is nearest to the words left."""
    keys = ("odds", "doc_id", "text_hash", "size")
    left = headed.groupBy("source").agg(
        (F.first("rest") - F.coalesce(F.sum(F.when(F.col("more") == 1, F.col("size"))), F.lit(0))).alias("gap")
    )
    waiting = headed.where("more = 0").join(
        few(left.select(F.col("source").alias("of"), "gap")), F.col("source").eqNullSafe(F.col("of"))
    )
    best = (
        waiting.where("size > 0 and size < 2 * gap")
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), *keys)).alias("best"))
        .select(F.col("source").alias("of"), "best")
    )
    joined = headed.join(few(best), F.col("source").eqNullSafe(F.col("of")), "left")
    is_best = (F.col("more") == 0) & F.coalesce(
        F.struct("odds", "doc_id", "text_hash", "size").eqNullSafe(F.struct(*[F.col(f"best.{k}").alias(k) for k in keys])),
        F.lit(False),
    )
    # Repeated rows share all keys: only one of them is the document added.
    row = F.row_number().over(Window.partitionBy("source", *keys).orderBy("more"))
    chosen = joined.withColumn("is_best", is_best)
    one = chosen.where("is_best").withColumn("more", F.when(row == 1, 1).otherwise(0))
    result = one.unionByName(chosen.where("not is_best"))
    copies = (F.col("whole") + F.col("more")).cast("int")
    return result.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
