"""SQL for DuckDB that every deterministic query must agree with.

The text is written independently of the operators, as plain SQL over the given tables. Literals are
cast to double because DuckDB reads ``0.15`` as an exact decimal.
"""

from __future__ import annotations

C = "TIMESTAMP '2000-08-01 00:00:00'"
YEAR = "TIMESTAMP '1999-08-01 00:00:00'"
HALF = "TIMESTAMP '2000-02-01 00:00:00'"
QUARTER = "TIMESTAMP '2000-05-01 00:00:00'"


def d(number) -> str:
    return f"{number}::double"


def half_up(expr: str, digits: int) -> str:
    scale = f"{10 ** digits}.0"
    return f"(floor(({expr}) * {d(scale)} + {d('0.5')})::double / {d(scale)})"


def six(expr: str) -> str:
    return half_up(expr, 6)


def micro(expr: str) -> str:
    return f"cast(floor(({expr}) * {d('1000000.0')} + {d('0.5')}) as bigint)"


#: Key of a complaint from its conversation and turn.
COMPLAINT = "cast('0x' || substr(md5(conv_id || ':' || turn), 1, 15) AS bigint)"

FACTS = f"""
oh AS (
  SELECT o_custkey AS custkey,
    min(CASE WHEN o_orderdate < {C} THEN o_orderdate END) AS first_order,
    max(CASE WHEN o_orderdate < {C} THEN o_orderdate END) AS last_order,
    cast(sum(CASE WHEN o_orderdate < {C} THEN cast(round(o_totalprice*100) AS bigint) END) AS bigint) AS cents_all,
    cast(sum(CASE WHEN o_orderdate < {C} AND o_orderdate >= {HALF} THEN cast(round(o_totalprice*100) AS bigint) END) AS bigint) AS cents_half,
    cast(sum(CASE WHEN o_orderdate < {C} AND o_orderdate >= {QUARTER} THEN cast(round(o_totalprice*100) AS bigint) END) AS bigint) AS cents_quarter,
    count(CASE WHEN o_orderdate < {C} AND o_orderdate >= {HALF} THEN 1 END) AS orders_half,
    count(CASE WHEN o_orderdate < {C} AND o_orderdate >= {QUARTER} THEN 1 END) AS orders_quarter,
    count(CASE WHEN o_orderdate < {C} AND o_orderstatus = 'F' THEN 1 END) AS orders_closed,
    count(CASE WHEN o_orderdate < {C} THEN 1 END) AS orders_all,
    count(CASE WHEN o_orderdate >= {C} THEN 1 END) AS orders_later
  FROM orders GROUP BY 1),
ih AS (
  SELECT o_custkey AS custkey,
    count(CASE WHEN o_orderdate >= {HALF} AND o_orderdate < {C} THEN 1 END) AS items_half,
    count(CASE WHEN l_shipdate >= {QUARTER} AND l_shipdate < {C} THEN 1 END) AS shipped_quarter,
    count(CASE WHEN l_shipdate >= {QUARTER} AND l_shipdate < {C} AND l_returnflag = 'R' THEN 1 END) AS returned_quarter,
    count(CASE WHEN l_shipdate >= {HALF} AND l_shipdate < {C} AND l_returnflag = 'R' THEN 1 END) AS returned_half,
    count(DISTINCT CASE WHEN o_orderdate >= {YEAR} AND o_orderdate < {C} THEN p_type END) AS types_used
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1),
eh AS (SELECT user_id AS custkey, count(CASE WHEN event_type <> 'error' THEN 1 END) AS logins FROM events GROUP BY 1),
facts AS (
  SELECT c_custkey AS custkey, c_nationkey, c_acctbal, r_name AS region, c_mktsegment AS segment,
    oh.* EXCLUDE (custkey), ih.* EXCLUDE (custkey), eh.logins
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN oh ON oh.custkey = c_custkey LEFT JOIN ih ON ih.custkey = c_custkey LEFT JOIN eh ON eh.custkey = c_custkey),
one AS (
  SELECT *, 'CLI-' || lpad(cast(custkey AS varchar), cast(greatest(7, len(cast(custkey AS varchar))) AS int), '0') AS customer_id,
    cast(18 + (custkey * 37) % 63 AS int) AS age,
    cast(coalesce(date_diff('day', first_order, {C}) // 30, 0) AS int) AS tenure_months,
    cents_half::double / {d('100.0')} * {d('50.0')} / {d('6.0')} AS avg_balance_6m,
    cast(coalesce(items_half, 0) AS int) AS monthly_transactions,
    cast(logins AS int) AS app_logins_30d,
    cast(coalesce(types_used, 0) AS int) AS n_products,
    coalesce(cents_all::double / {d('100.0')}, {d('0.0')}) * {d('0.5')} AS clv_score,
    cast(CASE WHEN shipped_quarter > 0 THEN returned_quarter END AS int) AS n_complaints_3m,
    cast(CASE WHEN custkey % 10 <> 0 THEN (custkey * 7) % 11 END AS int) AS nps_score,
    cast(date_diff('day', last_order, {C}) AS int) AS days_since_last_contact,
    cast(last_order AS date) AS last_contact_date,
    cast(CASE WHEN custkey % 97 <> 0 THEN CASE WHEN coalesce(orders_later, 0) > 0 THEN 0 ELSE 1 END END AS int) AS churn_label
  FROM facts),
raw AS (
  SELECT customer_id, cast(age + copy AS int) AS age, tenure_months, region, segment, avg_balance_6m, monthly_transactions,
    app_logins_30d, n_products, clv_score, n_complaints_3m, nps_score, days_since_last_contact, last_contact_date,
    churn_label, cast({C} - to_days(cast(copy AS int)) AS timestamp) AS ingestion_ts
  FROM (SELECT *, unnest(CASE WHEN custkey % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM one))
"""

RAW_COLUMNS = (
    "customer_id, age, tenure_months, region, segment, avg_balance_6m, monthly_transactions, app_logins_30d, n_products, "
    "clv_score, n_complaints_3m, nps_score, days_since_last_contact, last_contact_date, churn_label, ingestion_ts"
)

SILVER = FACTS + f""",
latest AS (
  SELECT {RAW_COLUMNS} FROM raw
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ingestion_ts DESC NULLS LAST, age DESC NULLS LAST) = 1),
silver AS (
  SELECT customer_id, try_cast(age AS int) AS age, tenure_months, region, segment, avg_balance_6m, monthly_transactions,
    coalesce(app_logins_30d, 0) AS app_logins_30d, n_products, clv_score, coalesce(n_complaints_3m, 0) AS n_complaints_3m,
    coalesce(nps_score, 5) AS nps_score, days_since_last_contact, last_contact_date, churn_label, ingestion_ts
  FROM latest WHERE customer_id IS NOT NULL AND churn_label IS NOT NULL)
"""

GOLD = SILVER + f""",
gold AS (
  SELECT *,
    CASE WHEN tenure_months > 0 THEN avg_balance_6m / tenure_months ELSE {d('0.0')} END AS balance_per_tenure,
    CASE WHEN n_products > 0 THEN monthly_transactions::double / n_products ELSE {d('0.0')} END AS txn_per_product,
    CASE WHEN tenure_months > 0 THEN clv_score / tenure_months ELSE {d('0.0')} END AS clv_per_month,
    app_logins_30d * {d('0.6')} + monthly_transactions * {d('0.4')} AS digital_engagement_score,
    CASE WHEN tenure_months > 0 THEN n_complaints_3m / (tenure_months / {d('12.0')}) ELSE n_complaints_3m::double END AS complaint_intensity,
    cast(CASE WHEN nps_score <= 6 THEN 0 WHEN nps_score <= 8 THEN 1 ELSE 2 END AS int) AS nps_bucket,
    cast(CASE WHEN days_since_last_contact > 90 THEN 3 WHEN days_since_last_contact > 30 THEN 2
      WHEN days_since_last_contact > 14 THEN 1 ELSE 0 END AS int) AS recency_risk,
    cast((avg_balance_6m > 5000000 OR n_products >= 4 OR clv_score > 1000000) AS int) AS is_high_value
  FROM silver)
"""

_SIGNALS = (
    ("avg_balance_6m < 100000", "0.15", "Saldo bajo"),
    ("monthly_transactions < 5", "0.20", "Baja actividad transaccional"),
    ("app_logins_30d < 3", "0.15", "Baja interacción digital"),
    ("n_complaints_3m >= 2", "0.25", "Múltiples reclamos recientes"),
    ("nps_score <= 4", "0.20", "NPS crítico (Detractor)"),
    ("days_since_last_contact > 60", "0.10", "Sin contacto reciente"),
    ("n_products = 1", "0.10", "Producto único (baja vinculación)"),
)
_RULE_SUM = d("0.0") + "".join(f" + CASE WHEN {p} THEN {d(w)} ELSE {d('0.0')} END" for p, w, _ in _SIGNALS)
RULE_SCORE = half_up(f"least(greatest({_RULE_SUM}, {d('0.0')}), {d('1.0')})", 4)
FACTORS = (
    "array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for p, _, n in _SIGNALS)
    + "], lambda x: x IS NOT NULL)[1:3], '|')"
)
VIP_LINEAR = (
    f"avg_balance_6m * {d('0.30')} / {d('1000000.0')} + clv_score * {d('0.25')} / {d('1000000.0')} + n_products * {d('0.20')} / {d('8.0')}"
    f" + tenure_months * {d('0.15')} / {d('360.0')} + monthly_transactions * {d('0.10')} / {d('50.0')}"
)
VIP_CAPPED = half_up(
    f"least(coalesce(avg_balance_6m, 0) / {d('10000000.0')}, {d('1.0')}) * {d('0.35')}"
    f" + least(coalesce(clv_score, 0) / {d('2000000.0')}, {d('1.0')}) * {d('0.30')}"
    f" + least(coalesce(n_products, 0) / {d('8.0')}, {d('1.0')}) * {d('0.20')}"
    f" + least(coalesce(tenure_months, 0) / {d('240.0')}, {d('1.0')}) * {d('0.15')}",
    4,
)


def vip_tier(s: str) -> str:
    return (
        f"CASE WHEN {s} >= {d('0.7')} THEN 'PLATINUM' WHEN {s} >= {d('0.5')} THEN 'GOLD' "
        f"WHEN {s} >= {d('0.3')} THEN 'SILVER' ELSE 'STANDARD' END"
    )


def risk_level(s: str) -> str:
    return (
        f"CASE WHEN {s} >= {d('0.7')} THEN 'ALTO' WHEN {s} >= {d('0.4')} THEN 'MEDIO' "
        f"WHEN {s} >= {d('0.2')} THEN 'BAJO' ELSE 'SIN_RIESGO' END"
    )


def action(s: str) -> str:
    return (
        f"CASE WHEN {s} >= {d('0.7')} THEN 'LLAMADA_EJECUTIVO' WHEN {s} >= {d('0.4')} THEN 'CAMPAÑA_RETENCIÓN' "
        f"WHEN {s} >= {d('0.2')} THEN 'OFERTA_DIGITAL' ELSE 'MONITOREO' END"
    )


SCORED = GOLD + f""",
ruled AS (SELECT *, {RULE_SCORE} AS churn_probability, {FACTORS} AS factors,
  {VIP_LINEAR} AS vip_score, {VIP_CAPPED} AS vip_capped FROM gold),
scored AS (SELECT *, {risk_level('churn_probability')} AS churn_risk_level, {action('churn_probability')} AS recommended_action,
  {vip_tier('vip_score')} AS vip_classification FROM ruled)
"""

BEHAVIOUR = FACTS + f""",
behaviour AS (
  SELECT customer_id,
    least(greatest(coalesce(days_since_last_contact, 180)::double, {d('0.0')}), {d('180.0')}) AS dias_sin_app,
    least(greatest(CASE WHEN ce > 0 THEN {half_up("(cr - ce) * 100.0::double / ce", 0)} ELSE {d('0.0')} END, {d('-80.0')}), {d('50.0')}) AS var_saldo_pct,
    least(greatest(CASE WHEN oe > 0 THEN {half_up("(orr - oe) * 100.0::double / oe", 0)} ELSE {d('0.0')} END, {d('-90.0')}), {d('40.0')}) AS var_transacciones_pct,
    cast(least(greatest(n_products, 1), 6) AS int) AS num_productos,
    cast(least(greatest(coalesce(returned_half, 0), 0), 10) AS int) AS reclamos_6m,
    least(greatest({half_up("tenure_months / 12.0::double", 1)}, {d('0.5')}), {d('20.0')}) AS antiguedad_anos,
    coalesce(CASE WHEN orders_all > 0 THEN {half_up("orders_closed * 100.0::double / orders_all", 0)} END, {d('0.0')}) AS uso_tarjeta_credito,
    least(greatest(coalesce(nps_score, 5)::double, {d('1.0')}), {d('10.0')}) AS score_satisfaccion,
    cast(coalesce(churn_label, 0) AS int) AS churn
  FROM (SELECT *, coalesce(cents_quarter, 0) AS cr, coalesce(cents_half, 0) - coalesce(cents_quarter, 0) AS ce,
    coalesce(orders_quarter, 0) AS orr, coalesce(orders_half, 0) - coalesce(orders_quarter, 0) AS oe FROM one))
"""

DEMOGRAPHIC = FACTS + f""",
demographic AS (
  SELECT customer_id, age AS edad, CASE WHEN custkey % 2 = 0 THEN 'masculino' ELSE 'femenino' END AS genero,
    CASE c_nationkey % 3 WHEN 0 THEN 'España' WHEN 1 THEN 'Francia' ELSE 'Alemania' END AS pais,
    cast(least(tenure_months // 12, 10) AS int) AS "antiguedad_años",
    greatest(c_acctbal, {d('0.0')}) * {d('25.0')} AS saldo,
    cast(least(greatest(n_products, 1), 4) AS int) AS num_productos,
    CASE WHEN coalesce(orders_closed, 0) > 0 THEN 1 ELSE 0 END AS tiene_tarjeta,
    CASE WHEN days_since_last_contact <= 90 THEN 1 ELSE 0 END AS miembro_activo,
    (15000 + (custkey * 7919) % 105001)::double AS salario_estimado,
    cast(least(coalesce(returned_half, 0), 3) AS int) AS quejas_recibidas,
    CASE WHEN coalesce(logins, 0) > 0 THEN 1 ELSE 0 END AS uso_app_movil,
    cast(300 + (custkey * 31) % 600 AS int) AS score_credito,
    cast(coalesce(churn_label, 0) AS int) AS churn
  FROM one)
"""
