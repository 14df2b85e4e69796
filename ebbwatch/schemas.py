"""Explicit schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_RAW = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("tenure_months", T.IntegerType()),
        T.StructField("region", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("avg_balance_6m", T.DoubleType()),
        T.StructField("monthly_transactions", T.IntegerType()),
        T.StructField("app_logins_30d", T.IntegerType()),
        T.StructField("n_products", T.IntegerType()),
        T.StructField("clv_score", T.DoubleType()),
        T.StructField("n_complaints_3m", T.IntegerType()),
        T.StructField("nps_score", T.IntegerType()),
        T.StructField("days_since_last_contact", T.IntegerType()),
        T.StructField("last_contact_date", T.DateType()),
        T.StructField("churn_label", T.IntegerType()),
        T.StructField("ingestion_ts", T.TimestampNTZType()),
    ]
)

COMPLAINTS = T.StructType(
    [
        T.StructField("complaint_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("complaint_text", T.StringType()),
        T.StructField("complaint_date", T.DateType()),
        T.StructField("channel", T.StringType()),
    ]
)

# One scoring request; ranges are in constants.REQUEST_RANGES.
SCORING_REQUEST = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("tenure_months", T.IntegerType()),
        T.StructField("region", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("avg_balance_6m", T.DoubleType()),
        T.StructField("monthly_transactions", T.IntegerType()),
        T.StructField("app_logins_30d", T.IntegerType()),
        T.StructField("n_products", T.IntegerType()),
        T.StructField("clv_score", T.DoubleType()),
        T.StructField("n_complaints_3m", T.IntegerType()),
        T.StructField("nps_score", T.IntegerType()),
        T.StructField("days_since_last_contact", T.IntegerType()),
        T.StructField("last_complaint_text", T.StringType()),
    ]
)

BATCH_REQUEST = T.StructType([T.StructField("customers", T.ArrayType(SCORING_REQUEST))])

SCORING_RESPONSE_COLUMNS = (
    "customer_id",
    "churn_probability",
    "churn_risk_level",
    "recommended_action",
    "vip_classification",
    "vip_score",
    "churn_intent_from_text",
    "top_risk_factors",
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("churn_risk_level", T.StringType()),
        T.StructField("day", T.StringType()),
    ]
)
