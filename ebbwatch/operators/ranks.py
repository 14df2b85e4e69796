"""Exact positions, running totals and quantiles without a window over one big group.

Each operator splits a group into deterministic ordered bins, ranks inside the bins in parallel
and adds the totals of the bins below. Only the bin totals meet in one task, and their number is
bounded by the bin definition, not by the data. Where values crowd, a bin is cut into finer ones, whose totals
meet bin by bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.functions.scalar import monotone_bin
from ebbwatch.operators.skew import heavy_join

#: Fine bins of one doubling; 2 ** FINER of them make a bin. They part values that differ by a relative 2 ** -22.
FINE_PER_OCTAVE, FINER = 1 << 22, 11


def join_with_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of which null equals null; the keys stand once in the result."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_of_{k}" for k in keys])


def hashed_positions(
    df: DataFrame, key: str, strata: Sequence[str] = (), salt: str = "", digits: int = 3, name: str = "position"
) -> DataFrame:
    """Position 1..n (``name``) and size (``name_of``) of each row in its stratum, in md5 order of the key.

    The leading hash digits are the bins: 16^digits for each stratum, equally filled. The key must
    be unique and the strata few (class labels and the like): their offsets meet in one task each.
    """
    strata = list(strata)
    bins = [*strata, "_bin"]
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))))
    hashed = hashed.withColumn("_bin", F.substring("_hash", 1, digits))
    whole = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(1))
    below = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*bins)
        .agg(F.count("*").alias("_n"))
        .withColumns({"_before": F.coalesce(F.sum("_n").over(below), F.lit(0)), f"{name}_of": F.sum("_n").over(whole)})
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(*bins).orderBy("_hash", key))
    ranked = hashed.withColumn("_inside", inside)
    # the window has partitioned the rows by bin already, so only the few offsets are shuffled here
    joined = join_with_nulls(ranked, offsets, bins)
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop("_hash", "_bin", "_inside", "_before")


def running_totals(
    df: DataFrame, order: str, values: Sequence[str], group: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Adds ``<value>_before`` and ``<value>_all`` for rows that are unique per (group, order).

    Hot order values must already be summed into one row, as ``groupBy(group, order)`` leaves them. Bins are cut
    twice: totals of bins are cumulated for each group, those of fine bins for each bin, and rows are ordered inside
    a fine bin, so values that crowd around one number are spread over 2,048 windows.
    """
    group = list(group)
    fine = monotone_bin(order, FINE_PER_OCTAVE)
    binned = df.withColumn("_fine", fine).withColumn("_bin", F.shiftright("_fine", FINER))

    def sort(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    def below(partition: Sequence[str], by: str) -> Column:
        over = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(1))
        return over.orderBy(sort(by)).rowsBetween(Window.unboundedPreceding, -1)

    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    parts = binned.groupBy(*group, "_bin", "_fine").agg(*[F.sum(v).alias(f"_f_{v}") for v in values])
    sums = parts.groupBy(*group, "_bin").agg(*[F.sum(f"_f_{v}").alias(f"_s_{v}") for v in values])
    offsets = sums.select(
        *group,
        "_bin",
        *[F.coalesce(F.sum(f"_s_{v}").over(below(group, "_bin")), F.lit(0)).alias(f"_o_{v}") for v in values],
        *[F.sum(f"_s_{v}").over(whole).alias(f"{v}_all") for v in values],
    )
    finer = parts.select(
        *group,
        "_bin",
        "_fine",
        *[F.coalesce(F.sum(f"_f_{v}").over(below([*group, "_bin"], "_fine")), F.lit(0)).alias(f"_p_{v}") for v in values],
    )
    offsets = join_with_nulls(finer, offsets, [*group, "_bin"]).drop("_bin")
    fine_bins = [*group, "_fine"]
    inside = below(fine_bins, order)
    local = binned.drop("_bin").withColumns({f"_i_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    joined = join_with_nulls(local, offsets, fine_bins)
    before = {f"{v}_before": F.col(f"_i_{v}") + F.col(f"_p_{v}") + F.col(f"_o_{v}") for v in values}
    return joined.withColumns(before).drop("_fine", *[f"_{k}_{v}" for v in values for k in "ipo"])


def rank_within(df: DataFrame, group: str, order: str, name: str = "rank") -> DataFrame:
    """``rank()`` by falling ``order`` inside ``group``, exact, for groups of any size; nulls are a group, and rank last.

    Rows of equal value are counted first, so ranking works on distinct values; in the join back, the rows of a value
    that holds many are dealt over many tasks.
    """
    counted = df.groupBy(group, order).agg(F.count("*").alias("_n"))
    ranks = running_totals(counted, order, ["_n"], [group], descending=True)
    ranks = ranks.select(group, order, (F.col("_n_before") + 1).alias(name))
    return heavy_join(df, ranks, [group, order], counted, "_n")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], kind: str = "linear") -> DataFrame:
    """Exact quantiles of many columns: rows (feature, prob, value).

    ``linear`` interpolates between neighbours, ``disc`` takes the smallest value that reaches the
    share. Values are counted per column first; then the bin that holds each target position is
    found from bin totals, and only the values of those bins are ordered.
    """
    if kind not in ("linear", "disc"):
        raise ValueError(f"kind must be 'linear' or 'disc', not {kind!r}")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(cells)).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n"))
    )
    binned = counts.withColumn("bin", monotone_bin("value"))
    whole = Window.partitionBy("feature")
    below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        binned.groupBy("feature", "bin")
        .agg(F.sum("n").alias("bin_n"))
        .withColumns({"bin_before": F.coalesce(F.sum("bin_n").over(below), F.lit(0)), "total": F.sum("bin_n").over(whole)})
    )
    prob = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    asked = bins.withColumn("prob", prob)
    if kind == "linear":
        exact = (F.col("total") - 1) * F.col("prob")
        asked = asked.withColumns({"low": F.floor(exact), "high": F.ceil(exact), "share": exact - F.floor(exact)})
    else:
        target = F.greatest(F.ceil(F.col("total") * F.col("prob")) - 1, F.lit(0))
        asked = asked.withColumns({"low": target, "high": target, "share": F.lit(0.0)})
    bin_end = F.col("bin_before") + F.col("bin_n")
    holds = lambda t: (F.col(t) >= F.col("bin_before")) & (F.col(t) < bin_end)
    asked = asked.where(holds("low") | holds("high")).select("feature", "bin", "bin_before", "prob", "low", "high", "share")
    hit_bins = asked.select("feature", "bin", "bin_before").distinct()
    # at most two bins for each feature and probability
    inside = Window.partitionBy("feature", "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        binned.join(F.broadcast(hit_bins), ["feature", "bin"])
        .withColumn("start", F.col("bin_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .select("feature", "bin", "value", "start", (F.col("start") + F.col("n")).alias("end"))
    )
    covers = lambda t: (F.col(t) >= F.col("start")) & (F.col(t) < F.col("end"))
    found = placed.join(F.broadcast(asked.drop("bin_before")), ["feature", "bin"]).groupBy("feature", "prob", "share").agg(
        F.max(F.when(covers("low"), F.col("value"))).alias("low_value"),
        F.max(F.when(covers("high"), F.col("value"))).alias("high_value"),
    )
    value = F.col("low_value") + (F.col("high_value") - F.col("low_value")) * F.col("share")
    return found.select("feature", "prob", value.alias("value"))
