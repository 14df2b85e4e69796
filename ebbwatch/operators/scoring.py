"""Silver to gold, rule scores, risk bands and VIP tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions import scalar as S
from ebbwatch.operators.quality import stamp


def gold_features() -> dict[str, Column]:
    """Derived features by name; one projection, no shuffle."""
    years = F.col("tenure_months") / F.lit(12.0)
    complaints = F.col("n_complaints_3m")
    return {
        "balance_per_tenure": S.guarded_ratio("avg_balance_6m", "tenure_months"),
        "txn_per_product": S.guarded_ratio("monthly_transactions", "n_products"),
        "clv_per_month": S.guarded_ratio("clv_score", "tenure_months"),
        "digital_engagement_score": S.weighted_sum(K.ENGAGEMENT_WEIGHTS),
        "complaint_intensity": F.when(F.col("tenure_months") > 0, complaints / years).otherwise(
            complaints.cast("double")
        ),
        "nps_bucket": S.band("nps_score", K.NPS_CUTS, K.NPS_BUCKETS, closed="right", null_label=K.NPS_BUCKETS[-1]),
        "recency_risk": S.band("days_since_last_contact", K.RECENCY_CUTS, K.RECENCY_LEVELS, closed="right"),
        "is_high_value": F.expr(K.HIGH_VALUE_TEST).cast("int"),
    }


def silver_to_gold(df: DataFrame) -> DataFrame:
    return df.withColumns(gold_features()).transform(stamp, "gold_ts")


def risk_level(score: Column | str) -> Column:
    return S.band(score, K.RISK_CUTS, K.RISK_LABELS)


def recommended_action(score: Column | str) -> Column:
    return S.band(score, K.RISK_CUTS, K.RISK_ACTIONS)


def vip_tier(score: Column | str) -> Column:
    return S.band(score, K.VIP_CUTS, K.VIP_LABELS)


def add_rule_score(df: DataFrame) -> DataFrame:
    """Heuristic churn score with its leading factors.

    The sum is rounded to four digits before banding, because sums of tenths land beside the cuts.
    """
    raw = S.rule_score(K.CHURN_SIGNALS)
    return df.withColumns(
        {
            "churn_probability": S.round_half_up(raw, 4),
            "top_risk_factors": S.fired_rules(K.CHURN_SIGNALS, limit=3),
        }
    )


def add_risk_bands(df: DataFrame, score: str = "churn_probability") -> DataFrame:
    return df.withColumns({"churn_risk_level": risk_level(score), "recommended_action": recommended_action(score)})


def add_vip(df: DataFrame, formula: str = "linear") -> DataFrame:
    """VIP score and tier by one of the two formulas in use."""
    if formula == "linear":
        score = S.vip_score_linear(K.VIP_LINEAR_TERMS)
    elif formula == "capped":
        score = S.vip_score_capped(K.VIP_CAPPED_TERMS)
    else:
        raise ValueError(f"unknown VIP formula {formula!r}")
    return df.withColumn("vip_score", score).withColumn("vip_classification", vip_tier("vip_score"))


def score_requests(df: DataFrame, text: str = "last_complaint_text") -> DataFrame:
    """Rule scoring of request rows: the same projection for one row, a batch or a stream."""
    scored = df.transform(add_rule_score).transform(add_risk_bands).transform(add_vip, "capped")
    proxy = S.text_intent_proxy("churn_probability", text, K.TEXT_PROXY_SLOPE, K.TEXT_PROXY_SHIFT)
    return scored.withColumn("churn_intent_from_text", proxy)


def demographic_probability() -> Column:
    low, high = K.DEMOGRAPHIC_RANGE
    return S.rule_score(K.DEMOGRAPHIC_SIGNALS, base=K.DEMOGRAPHIC_BASE, low=low, high=high)


def clv_formula() -> Column:
    """Simple lifetime value, floored at zero, two digits; null where a term is unknown."""
    total = S.weighted_sum(K.CLV_TERMS)
    return F.when(total.isNotNull(), S.round_half_up(F.greatest(total, F.lit(0.0)), 2))


def percent_view(df: DataFrame, score: str, key: str = "customer_id") -> DataFrame:
    """Likelier class with its label, and both class probabilities in percent."""
    leave, stay = F.col(score), F.lit(1.0) - F.col(score)
    return df.select(
        key,
        F.when(leave > stay, 1).otherwise(0).alias("prediccion"),
        F.when(leave > stay, "CHURN").otherwise("NO CHURN").alias("etiqueta"),
        S.round_half_up(stay * 100.0, 2).alias("prob_no_churn"),
        S.round_half_up(leave * 100.0, 2).alias("prob_churn"),
    )


def join_intent(df: DataFrame, intent: DataFrame) -> DataFrame:
    """Left join of the per-customer intent; customers without text get 0.0."""
    scores = intent.select("customer_id", "churn_intent_score")
    return df.join(scores, "customer_id", "left").fillna({"churn_intent_score": 0.0})


def customer_profile(scored: DataFrame, complaints: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Scored customer with the number, last date and last channel of the complaints."""
    if customer_id is not None:
        scored = scored.where(F.col("customer_id") == customer_id)
        complaints = complaints.where(F.col("customer_id") == customer_id)
    last = F.max(F.struct("complaint_date", "complaint_id", "channel"))
    told = complaints.groupBy("customer_id").agg(F.count("*").alias("n_texts"), last.alias("_last"))
    return scored.join(told, "customer_id", "left").select(
        *scored.columns,
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
        F.col("_last.complaint_date").alias("last_text_date"),
        F.col("_last.channel").alias("last_text_channel"),
    )
