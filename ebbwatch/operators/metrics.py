"""Evaluation of binary scores as DataFrames; every metric is one or two aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.operators.ranks import running_totals
from ebbwatch.operators.reports import distribution


def threshold_predict(score: Column | str, threshold: float = 0.5) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return (score >= threshold).cast("int")


def confusion(df: DataFrame, label: str, prediction: str, group: Sequence[str] = ()) -> DataFrame:
    """Counts tp, fp, tn, fn."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*group).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages.

    Works on the one row of ``confusion``; divisions by zero give 0.
    """
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def line(name: str, hit: Column, false_alarm: Column, missed: Column) -> Column:
        precision, recall = _ratio(hit, hit + false_alarm), _ratio(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("class_name"),
            precision.alias("precision"),
            recall.alias("recall"),
            _ratio(precision * recall * 2.0, precision + recall).alias("f1"),
            (hit + missed).alias("support"),
        )

    wide = counts.select(line("0", tn, fn, fp).alias("c0"), line("1", tp, fp, fn).alias("c1"), _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"))
    n0, n1 = F.col("c0.support"), F.col("c1.support")

    def average(name: str, mix) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"),
            *[mix(F.col(f"c0.{m}"), F.col(f"c1.{m}")).alias(m) for m in ("precision", "recall", "f1")],
            (n0 + n1).alias("support"),
        )

    macro = average("macro avg", lambda a, b: (a + b) / 2.0)
    weighted = average("weighted avg", lambda a, b: _ratio(a * n0 + b * n1, n0 + n1))
    overall = F.struct(
        F.lit("accuracy").alias("class_name"),
        *[F.col("accuracy").alias(m) for m in ("precision", "recall", "f1")],
        (n0 + n1).alias("support"),
    )
    return wide.select(F.inline(F.array(F.col("c0"), F.col("c1"), overall, macro, weighted)))


def score_ladder(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with positives and negatives at it, above it and in total.

    Hot scores collapse before the shuffle; positions come from bin totals, never from one window
    over all scores.
    """
    y = F.col(label)
    counted = (
        df.where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*group, F.col(score).alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    return running_totals(counted, "score", ["pos", "neg"], group, descending=True)


def _won() -> Column:
    """Pairs a positive wins against the negatives of this score; a tie counts one half."""
    return F.sum(F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") * 0.5))


def _pairs() -> Column:
    return F.max("pos_all").cast("double") * F.max("neg_all").cast("double")


def _pr_area() -> Column:
    """Area under precision-recall by trapezoids; the curve starts level at its first precision."""
    caught, alarms = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    precision = _ratio(caught, caught + alarms)
    seen = F.col("pos_before") + F.col("neg_before")
    previous = F.when(seen > 0, _ratio(F.col("pos_before"), seen)).otherwise(precision)
    return F.sum(_ratio(F.col("pos"), F.col("pos_all")) * (precision + previous) / 2.0)


def auc_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under ROC in rank form."""
    return score_ladder(df, label, score).agg(
        F.max("pos_all").alias("n_pos"), F.max("neg_all").alias("n_neg"), F.try_divide(_won(), _pairs()).alias("auc_roc")
    )


def auc_pr(df: DataFrame, label: str, score: str) -> DataFrame:
    return score_ladder(df, label, score).agg(_pr_area().alias("auc_pr"))


def grouped_auc(df: DataFrame, label: str, score: str, group: str) -> DataFrame:
    """Area under ROC for each value of ``group``."""
    return score_ladder(df, label, score, [group]).groupBy(group).agg(F.try_divide(_won(), _pairs()).alias("auc_roc"))


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All threshold and ranking metrics as rows (metric, value), from one pass over the scores."""
    hit = F.col("score") >= threshold
    one = score_ladder(df, label, score).agg(
        F.try_divide(_won(), _pairs()).alias("auc_roc"),
        _pr_area().alias("auc_pr"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
        F.max("pos_all").alias("p"),
        F.max("neg_all").alias("n"),
    )
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "p", "n"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, p)
    values = {
        "auc_roc": F.col("auc_roc"),
        "auc_pr": F.col("auc_pr"),
        "gini": F.col("auc_roc") * 2.0 - 1.0,
        "accuracy": _ratio(tp + n - fp, p + n),
        "precision": precision,
        "recall": recall,
        "f1": _ratio(precision * recall * 2.0, precision + recall),
    }
    cells = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()])
    return one.select(F.inline(cells))


def gini(df: DataFrame, label: str, score: str) -> DataFrame:
    return auc_roc(df, label, score).select((F.col("auc_roc") * 2.0 - 1.0).alias("gini"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at each distinct score used as threshold."""
    return score_ladder(df, label, score).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("neg_before") + F.col("neg"), F.col("neg_all")).alias("fpr"),
        _ratio(F.col("pos_before") + F.col("pos"), F.col("pos_all")).alias("tpr"),
    )


def ks_statistic(df: DataFrame, label: str, score: str) -> DataFrame:
    """Largest distance between the two classes' cumulative shares, and the highest score there."""
    points = roc_points(df, label, score).withColumn("gap", F.abs(F.col("tpr") - F.col("fpr")))
    best = F.max(F.struct("gap", "threshold"))
    return points.agg(best.alias("b")).select(F.col("b.gap").alias("ks"), F.col("b.threshold").alias("threshold"))


def log_loss(df: DataFrame, label: str, score: str, floor: float = 1e-15) -> DataFrame:
    """Mean cross-entropy of clipped scores, with accuracy at one half."""
    p = F.greatest(F.least(F.col(score), F.lit(1.0 - floor)), F.lit(floor))
    loss = -F.ln(F.when(F.col(label) == 1, p).otherwise(1.0 - p))
    hit = F.col(label) == threshold_predict(score)
    return df.agg(
        F.count("*").alias("n"), F.avg(loss).alias("log_loss"), _ratio(F.count_if(hit), F.count("*")).alias("accuracy")
    )


def lift_table(df: DataFrame, key: str, label: str, score: str, tiles: int = 10) -> DataFrame:
    """Response per score tile against the overall rate; tiles as ``ntile`` over falling score.

    Equal scores are ordered by key hash. A row's position is the rows above its score plus its
    position inside the score, so no window spans more than one hash bin of one score.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(key, label, F.col(score).alias("score"))
    ladder = score_ladder(rows, label, "score").select(
        "score",
        (F.col("pos_before") + F.col("neg_before")).alias("_above"),
        (F.col("pos_all") + F.col("neg_all")).alias("_rows"),
        F.col("pos_all").alias("_positives"),
    )
    bins = ["score", "_bin"]
    hashed = rows.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn("_bin", F.substring("_hash", 1, 3))
    placed = _positions_in_score(hashed, bins, key).join(ladder, "score")
    position = F.col("_above") + F.col("_at") - 1
    small, extra = F.floor(F.col("_rows") / tiles), F.col("_rows") % tiles
    big_rows = extra * (small + 1)
    tile = F.when(position < big_rows, F.floor(position / (small + 1))).otherwise(
        extra + F.floor((position - big_rows) / F.greatest(small, F.lit(1)))
    )
    per_tile = placed.withColumn("tile", (tile + 1).cast("int")).groupBy("tile").agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == 1).alias("n_churn"),
        F.max("_rows").alias("_rows"),
        F.max("_positives").alias("_positives"),
    )
    rate, overall = _ratio(F.col("n_churn"), F.col("n")), _ratio(F.col("_positives"), F.col("_rows"))
    return per_tile.select("tile", "n", "n_churn", rate.alias("churn_rate"), _ratio(rate, overall).alias("lift"))


def _positions_in_score(hashed: DataFrame, bins: Sequence[str], key: str) -> DataFrame:
    inside = F.row_number().over(Window.partitionBy(*bins).orderBy("_hash", key))
    below = Window.partitionBy("score").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy(*bins).agg(F.count("*").alias("_n")).select(
        *bins, F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before")
    )
    return hashed.withColumn("_inside", inside).join(offsets, list(bins)).withColumn("_at", F.col("_before") + F.col("_inside"))


def metric_goals(metrics: DataFrame, goals: Sequence[tuple[str, float]] = K.METRIC_GOALS) -> DataFrame:
    """Metric rows (metric, value) against their goals; the goal must be exceeded."""
    spark = metrics.sparkSession
    target = spark.createDataFrame(list(goals), "metric string, goal double")
    return metrics.join(F.broadcast(target), "metric").select(
        "metric", "value", "goal", (F.col("value") > F.col("goal")).alias("reached")
    )


def business_impact(counts: DataFrame) -> DataFrame:
    """Confusion counts scaled to the portfolio: retained customers, income, return on cost; null without a test."""
    tested = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    factor = F.try_divide(F.lit(float(K.PORTFOLIO_CUSTOMERS)), tested)
    scaled = counts.select(
        *[F.floor(F.col(c) * factor).cast("bigint").alias(f"{c}_portfolio") for c in ("tp", "fn", "fp")]
    )
    kept = scaled.withColumn("retained", F.floor(F.col("tp_portfolio") * K.RETAINED_SHARE).cast("bigint"))
    income = kept.withColumn("income", F.col("retained") * F.lit(K.CUSTOMER_VALUE).cast("bigint"))
    cost = F.lit(float(K.SYSTEM_COST))
    return income.withColumn("roi", (F.col("income") - cost) / cost)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and percent per label."""
    return distribution(df, label, "label")


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives, positives and the weight that balances them."""
    y = F.col(label)
    counted = df.agg(F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos"))
    return counted.select("n_neg", "n_pos", F.try_divide("n_neg", "n_pos").alias("weight_pos"), F.lit(1.0).alias("weight_neg"))

