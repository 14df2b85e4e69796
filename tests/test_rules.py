"""Row rules: every branch, cut values and nulls."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions import scalar as S
from ebbwatch.operators import quality as Q
from ebbwatch.operators import scoring as R
from ebbwatch.schemas import CUSTOMER_RAW, SCORING_REQUEST
from ebbwatch.sources import requests as J

SAMPLE = {
    "customer_id": "CLI-0000077", "age": 57, "tenure_months": 60, "region": "Sur", "segment": "Premium", "avg_balance_6m": 6200000.0,
    "monthly_transactions": 2, "app_logins_30d": 1, "n_products": 2, "clv_score": 275000.0, "n_complaints_3m": 2, "nps_score": 3,
    "days_since_last_contact": 68, "last_complaint_text": "Me cobraron dos veces la misma comisión",
}


def requests(spark, *changes):
    rows = [tuple({**SAMPLE, **c}[n] for n in SCORING_REQUEST.fieldNames()) for c in changes]
    return spark.createDataFrame(rows, SCORING_REQUEST)


def values(spark, numbers, expression, kind="double"):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_band_left_and_right(spark):
    numbers = [0.19, 0.2, 0.4, 0.7, 0.71, None]
    left = values(spark, numbers, S.band("x", K.RISK_CUTS, K.RISK_LABELS))
    assert left == ["SIN_RIESGO", "BAJO", "MEDIO", "ALTO", "ALTO", "SIN_RIESGO"]
    right = values(spark, [0.4, 0.41, 0.75, 0.76, None], S.band("x", K.HYBRID_CUTS, K.HYBRID_LABELS, closed="right"))
    assert right == ["BAJO", "MEDIO", "MEDIO", "ALTO", "BAJO"]


def test_band_rejects_bad_arguments():
    with pytest.raises(ValueError):
        S.band("x", (1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        S.band("x", (2, 1), ("a", "b", "c"))
    with pytest.raises(ValueError):
        S.band("x", (1,), ("a", "b"), closed="both")


def test_guarded_ratio_clip_and_rounding(spark):
    assert values(spark, [4.0, 0.0, -1.0, None], S.guarded_ratio(F.lit(8.0), "x")) == [2.0, 0.0, 0.0, 0.0]
    assert values(spark, [-5.0, 0.5, 7.0, None], S.clip("x", 0.0, 1.0)) == [0.0, 0.5, 1.0, None]
    assert values(spark, [0.125, 0.30000000000000004], S.round_half_up("x", 2)) == [0.13, 0.3]


def test_sample_request(spark):
    row = requests(spark, {}).transform(R.score_requests).collect()[0]
    assert row.churn_probability == 0.9
    assert (row.churn_risk_level, row.recommended_action) == ("ALTO", "LLAMADA_EJECUTIVO")
    assert row.vip_score == 0.3457 and row.vip_classification == "SILVER"
    assert list(row.top_risk_factors) == [
        "Baja actividad transaccional", "Baja interacción digital", "Múltiples reclamos recientes",
    ]
    assert row.churn_intent_from_text == 1.0


def test_factors_by_weight_and_unknown_order(spark):
    row = requests(spark, {}).select(S.fired_rules(K.CHURN_SIGNALS, 2, "weight").alias("f")).collect()[0]
    assert list(row.f) == ["Múltiples reclamos recientes", "Baja actividad transaccional"]
    with pytest.raises(ValueError):
        S.fired_rules(K.CHURN_SIGNALS, order="random")


def test_null_inputs_never_fire_a_rule(spark):
    blank = {c: None for c, _, _ in K.REQUEST_RANGES}
    row = requests(spark, {**blank, "last_complaint_text": None}).transform(R.score_requests).collect()[0]
    assert row.churn_probability == 0.0 and list(row.top_risk_factors) == []
    assert row.vip_score == 0.0 and row.vip_classification == "STANDARD"
    assert row.churn_intent_from_text is None


def test_empty_text_counts_as_absent(spark):
    row = requests(spark, {"last_complaint_text": ""}).transform(R.score_requests).collect()[0]
    assert row.churn_intent_from_text is None


def test_all_rules_fire_and_the_score_is_capped(spark):
    worst = {"avg_balance_6m": 99999.0, "n_products": 1, "nps_score": 0}
    row = requests(spark, worst).transform(R.score_requests).collect()[0]
    assert row.churn_probability == 1.0


def test_vip_linear_is_null_without_balance(spark):
    rows = requests(spark, {"avg_balance_6m": None}, {}).transform(R.add_vip, "linear").collect()
    assert rows[0].vip_score is None and rows[0].vip_classification == "STANDARD"
    assert rows[1].vip_score == pytest.approx(1.86 + 0.06875 + 0.05 + 0.025 + 0.004)
    with pytest.raises(ValueError):
        R.add_vip(requests(spark, {}), "cubic")


def test_gold_features_at_the_cuts(spark):
    cases = [
        {"tenure_months": 0, "n_products": 0, "nps_score": 6, "days_since_last_contact": 14, "clv_score": 1000000.0, "avg_balance_6m": None},
        {"tenure_months": 24, "nps_score": 7, "days_since_last_contact": 15, "n_complaints_3m": 3},
        {"nps_score": 8, "days_since_last_contact": 31, "n_products": 4, "avg_balance_6m": None},
        {"nps_score": 9, "days_since_last_contact": 91, "avg_balance_6m": 100.0},
        {"days_since_last_contact": None},
    ]
    rows = requests(spark, *cases).transform(R.silver_to_gold).collect()
    assert [r.nps_bucket for r in rows] == [0, 1, 1, 2, 0]
    assert [r.recency_risk for r in rows] == [0, 1, 2, 3, 0]
    assert [r.is_high_value for r in rows] == [None, 1, 1, 0, 1]
    assert rows[0].balance_per_tenure == 0.0 and rows[0].txn_per_product == 0.0 and rows[0].clv_per_month == 0.0
    assert rows[0].complaint_intensity == 2.0 and rows[1].complaint_intensity == 1.5
    assert rows[1].digital_engagement_score == pytest.approx(1.4)


def raw(spark, rows):
    blank = {n: None for n in CUSTOMER_RAW.fieldNames()}
    return spark.createDataFrame([tuple({**blank, **r}[n] for n in CUSTOMER_RAW.fieldNames()) for r in rows], CUSTOMER_RAW)


def test_last_write_wins_before_the_label_filter(spark):
    day = dt.datetime(2000, 1, 1)
    rows = [
        {"customer_id": "A", "age": 1, "churn_label": 1, "ingestion_ts": day},
        {"customer_id": "A", "age": 2, "churn_label": 0, "ingestion_ts": day + dt.timedelta(days=1)},
        {"customer_id": "B", "age": 3, "churn_label": 1, "ingestion_ts": day},
        {"customer_id": "B", "age": 4, "churn_label": None, "ingestion_ts": day + dt.timedelta(days=1)},
        {"customer_id": None, "age": 5, "churn_label": 1, "ingestion_ts": day},
        {"customer_id": "C", "age": 6, "churn_label": 1, "ingestion_ts": None},
        {"customer_id": "C", "age": 7, "churn_label": 1, "ingestion_ts": None},
    ]
    df = raw(spark, rows)
    kept = {r.customer_id: r for r in Q.raw_to_silver(df).collect()}
    assert {k: r.age for k, r in kept.items()} == {"A": 2, "C": 7}
    assert kept["A"].n_complaints_3m == 0 and kept["A"].app_logins_30d == 0 and kept["A"].nps_score == 5
    assert Q.quality_counts(df).collect()[0].asDict() == {"rows_in": 7, "rows_kept": 2, "rows_dropped": 5}


def test_silver_does_not_depend_on_partitioning(spark):
    rows = [{"customer_id": f"K{i % 5}", "age": i, "churn_label": 1, "ingestion_ts": dt.datetime(2000, 1, 1 + i % 3)} for i in range(60)]
    df = raw(spark, rows)
    results = [
        sorted((r.customer_id, r.age) for r in Q.raw_to_silver(d).collect()) for d in (df, df.repartition(7), df.orderBy(F.desc("age")))
    ]
    assert results[0] == results[1] == results[2]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = Q.raw_to_silver(raw(spark, []).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_unreadable_values_become_null(spark):
    df = spark.createDataFrame([("x", "12.5", "abc"), ("41", "bad", "7")], "age string, avg_balance_6m string, clv_score string")
    assert [tuple(r) for r in Q.enforce_types(df).collect()] == [(None, 12.5, None), (41, None, 7.0)]


def test_validation_and_quarantine(spark):
    df = requests(spark, {}, {"age": 17, "nps_score": 11}, {"segment": "Other", "n_products": 0}, {"clv_score": None})
    checked = Q.validate_rows(df)
    assert [list(r.violations) for r in checked.collect()] == [[], ["age", "nps_score"], ["n_products", "segment"], ["clv_score"]]
    good, bad = Q.split_valid(checked)
    assert (good.count(), bad.count()) == (1, 3)
    assert {r.check_name: r.n_violations for r in Q.validation_summary(checked).collect()}["age"] == 1


def test_request_parsing(spark):
    bodies = spark.createDataFrame([(1, '{"customer_id": "C1", "age": 30}'), (2, "not json")], "id int, body string")
    rows = {r.id: r for r in J.parse_requests(bodies).collect()}
    assert rows[1].is_readable and rows[1].age == 30 and rows[1].region is None
    assert not rows[2].is_readable and rows[2].customer_id is None
    batch = spark.createDataFrame([(1, '{"customers": [{"customer_id": "A"}, {"customer_id": "B"}]}'), (2, "[")], "id int, body string")
    assert sorted((r.id, r.item, r.customer_id) for r in J.parse_batch_requests(batch).collect() if r.id == 1) == [(1, 0, "A"), (1, 1, "B")]


def test_demographic_rule_probability(spark):
    base = "45 AS edad, 'Francia' AS pais, 4 AS `antiguedad_años`, 100.0D AS saldo, 2 AS num_productos, 0 AS tiene_tarjeta, 1 AS miembro_activo, 50000.0D AS salario_estimado, 0 AS quejas_recibidas, 0 AS uso_app_movil, 700 AS score_credito"
    worst = "60 AS edad, 'Alemania' AS pais, 0 AS `antiguedad_años`, 0.0D AS saldo, 4 AS num_productos, 0 AS tiene_tarjeta, 0 AS miembro_activo, 50000.0D AS salario_estimado, 3 AS quejas_recibidas, 0 AS uso_app_movil, 300 AS score_credito"
    best = "30 AS edad, 'Francia' AS pais, 4 AS `antiguedad_años`, 100.0D AS saldo, 2 AS num_productos, 1 AS tiene_tarjeta, 1 AS miembro_activo, 90000.0D AS salario_estimado, 0 AS quejas_recibidas, 1 AS uso_app_movil, 700 AS score_credito"
    got = [spark.sql(f"SELECT {s}").select(R.demographic_probability().alias("p")).collect()[0].p for s in (base, worst, best)]
    assert got[0] == 0.15 and got[1] == 0.97 and got[2] == 0.02


def test_no_keyword_flags_nothing(spark):
    assert values(spark, ["x", None], S.contains_any("x", ()), "string") == [False, False]


def test_versions_of_one_time_are_told_apart_by_any_column(spark):
    day = dt.datetime(2000, 1, 1)
    rows = [{"customer_id": "A", "age": 1, "churn_label": 1, "segment": s, "ingestion_ts": day} for s in ("x", "z", "y")]
    df = raw(spark, rows)
    assert {r.segment for d in (df, df.orderBy("segment"), df.orderBy(F.desc("segment"))) for r in Q.raw_to_silver(d).collect()} == {"z"}


def test_unknown_balance_has_no_lifetime_value(spark):
    rows = requests(spark, {"avg_balance_6m": None}, {"avg_balance_6m": -1e9}).select(R.clv_formula().alias("v")).collect()
    assert [r.v for r in rows] == [None, 0.0]


def test_dates_reach_the_scans_of_the_snapshot(spark, folder):
    from ebbwatch.sources.snapshot import customer_facts

    plan = customer_facts(spark, folder)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    for column in ("l_shipdate", "o_orderdate"):
        assert any(f"GreaterThanOrEqual({column}" in line for line in pushed)
