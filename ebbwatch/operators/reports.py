"""Distributions, descriptive statistics, portfolios, alerts, trends and masking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.operators.ranks import exact_quantiles, rank_within
from ebbwatch.sources.snapshot import cents


def distribution(df: DataFrame, column: str, name: str) -> DataFrame:
    """Count and percent per value; the share window runs over the few aggregated rows."""
    counted = df.groupBy(F.col(column).alias(name)).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("percent", F.col("n") * 100.0 / total)


def executive_summary(df: DataFrame, risk: str = "churn_risk_level", vip: str = "vip_classification") -> DataFrame:
    """Total and both distributions from one pass: sections total, risk and vip."""
    cells = F.array(
        F.struct(F.lit("total").alias("section"), F.lit("all").alias("value")),
        F.struct(F.lit("risk").alias("section"), F.col(risk).alias("value")),
        F.struct(F.lit("vip").alias("section"), F.col(vip).alias("value")),
    )
    counted = df.select(F.inline(cells)).groupBy("section", "value").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("section"))
    return counted.withColumn("percent", F.col("n") * 100.0 / total)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    value = F.col("value")
    moments = (
        df.select(F.inline(cells))
        .groupBy("feature")
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75)).groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return moments.join(quartiles, "feature", "left")


def class_histogram(df: DataFrame, label: str, feature: str, bins: int = 30, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Density histogram of a feature per class: equal bins between the class's own extremes."""
    value = F.col(feature).cast("double")
    rows = df.where(value.isNotNull() & F.col(label).isin(*classes)).select(F.col(label).alias("label"), value.alias("value"))
    # one row for each of `classes`
    edges = rows.groupBy("label").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("class_n")
    )
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    at = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (
        rows.join(F.broadcast(edges), "label")
        .groupBy("label", at.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.max("low").alias("low"), F.max("high").alias("high"), F.max("class_n").alias("class_n"))
        .select(
            "label",
            "bin",
            "n",
            (F.col("low") + F.col("bin") * width).alias("left_edge"),
            F.try_divide(F.col("n").cast("double"), F.col("class_n") * width).alias("density"),
        )
    )


def label_means(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in columns])


def risk_summary(df: DataFrame) -> DataFrame:
    """Customers, high-risk customers and mean score by region and segment, with subtotals.

    Scores carry four digits, so their sum is taken over whole ten-thousandths.
    """
    points = F.round(F.col("churn_probability") * 10000).cast("bigint")
    return (
        df.rollup("region", "segment")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.count("*").alias("n"),
            F.count_if(F.col("churn_risk_level") == "ALTO").alias("n_high"),
            F.sum(points).alias("_points"),
        )
        .withColumn("mean_score", F.col("_points") / 10000.0 / F.col("n"))
        .drop("_points")
    )


def vip_portfolio(df: DataFrame, tiers: Sequence[str] = ("PLATINUM", "GOLD")) -> DataFrame:
    """Customers of the upper tiers, ranked by lifetime value inside their region."""
    chosen = df.where(F.col("vip_classification").isin(*tiers)).select(
        "customer_id", "region", "segment", "vip_classification", "clv_score"
    )
    return rank_within(chosen, "region", "clv_score", "clv_rank")


def retention_alerts(df: DataFrame, risks: Sequence[str] = ("ALTO", "MEDIO")) -> DataFrame:
    """Customers at risk who are worth keeping, most urgent first."""
    return (
        df.where(F.col("churn_risk_level").isin(*risks) & (F.col("is_high_value") == 1))
        .select("customer_id", "region", "churn_probability", "churn_risk_level", "recommended_action", "clv_score", "vip_classification")
        .orderBy(F.desc("churn_probability"), F.desc("clv_score"), "customer_id")
    )


def behaviour_trends(orders: DataFrame, months: int = 3) -> DataFrame:
    """Monthly amount and order count per customer with change to the month before and a moving mean.

    Orders are summed per customer and month before the window, so a window partition holds at most
    one row for each calendar month.
    """
    day = F.col("o_orderdate").cast("date")
    month_no = (F.year(day) * 12 + F.month(day)).cast("int")
    monthly = orders.groupBy(F.col("o_custkey").alias("custkey"), month_no.alias("month_no")).agg(
        F.sum(cents("o_totalprice")).alias("cents"), F.count("*").alias("n_orders")
    )
    ordered = Window.partitionBy("custkey").orderBy("month_no")
    span = ordered.rangeBetween(-(months - 1), 0)
    before = ordered.rangeBetween(-1, -1)
    amount_before, orders_before = F.max("cents").over(before), F.max("n_orders").over(before)
    return monthly.select(
        "custkey",
        "month_no",
        "n_orders",
        (F.col("cents") / 100.0).alias("amount"),
        F.lag("month_no").over(ordered).alias("last_active_month"),
        (F.sum("cents").over(span) / 100.0 / months).alias("moving_amount"),
        F.try_divide((F.col("cents") - amount_before) * 100.0, amount_before).alias("var_saldo_pct"),
        F.try_divide((F.col("n_orders") - orders_before) * 100.0, orders_before).alias("var_transacciones_pct"),
    )


def anonymize(df: DataFrame, key: str, text: str, salt: str) -> DataFrame:
    """Replaces the key by a salted hash and masks digits and mail addresses in the text."""
    masked = F.regexp_replace(F.col(text), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+", "<mail>")
    masked = F.regexp_replace(masked, r"[0-9]", "#")
    return df.withColumns({key: F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256), text: masked})
