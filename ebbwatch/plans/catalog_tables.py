"""Sources, sinks, row rules and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions import scalar as S
from ebbwatch.functions import texts as X
from ebbwatch.operators import metrics as M
from ebbwatch.operators import quality as Q
from ebbwatch.operators import scoring as R
from ebbwatch.operators import splits
from ebbwatch.plans import oracle as O
from ebbwatch.plans.registry import gold, query, scored, silver
from ebbwatch.schemas import COMPLAINTS, CUSTOMER_RAW
from ebbwatch.sources import requests as J
from ebbwatch.sources import storage
from ebbwatch.sources.snapshot import behaviour, complaints, customer_key, customer_raw, demographic
from ebbwatch.sources.storage import read_table

d = O.d
TEST_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_SEG_SQL = ", ".join(f"'{s}'" for s in TEST_SEGMENTS)

# -------------------------------------------------------------------------------- sources and sinks


@query("scan_customers", f"WITH {O.FACTS} SELECT {O.RAW_COLUMNS} FROM raw")
def scan_customers(spark, folder):
    """Raw customers written as Parquet and read back with the fixed schema."""
    path = storage.scratch_path(spark, "raw-customers")
    storage.write_table(customer_raw(spark, folder), path)
    return storage.read_typed(spark, path, CUSTOMER_RAW)


@query(
    "scan_optional_complaints",
    f"WITH {O.SILVER} SELECT customer_id, {d('0.0')} AS churn_intent_score FROM silver",
)
def scan_optional_complaints(spark, folder):
    """The complaint table is missing: it reads as empty and every intent is the default."""
    absent = storage.read_optional(spark, f"{folder}/complaints.parquet", COMPLAINTS)
    intent = absent.select("customer_id", F.lit(None).cast("double").alias("churn_intent_score"))
    return R.join_intent(silver(spark, folder), intent).select("customer_id", "churn_intent_score")


@query(
    "scan_present_complaints",
    f"""WITH {O.SILVER}, k AS (SELECT 'CLI-' || lpad(cast(conv_id AS varchar), 7, '0') AS customer_id FROM conversations WHERE role = 'user'),
    told AS (SELECT customer_id, count(*) AS n FROM k GROUP BY 1)
    SELECT customer_id, CASE WHEN n IS NULL THEN {d('0.0')} ELSE {O.half_up('n / (n + 2.0::double)', 4)} END AS churn_intent_score
    FROM silver LEFT JOIN told USING (customer_id)""",
)
def scan_present_complaints(spark, folder):
    """The complaint table is there: it is written, read with its schema and joined; an intent by the number of texts."""
    path = f"{storage.scratch_path(spark, 'complaints')}/complaints.parquet"
    storage.write_table(complaints(spark, folder), path)
    told = storage.read_optional(spark, path, COMPLAINTS).groupBy("customer_id").agg(F.count("*").alias("n"))
    intent = told.select("customer_id", S.round_half_up(F.col("n") / (F.col("n") + 2.0), 4).alias("churn_intent_score"))
    return R.join_intent(silver(spark, folder), intent).select("customer_id", "churn_intent_score")


_EXPORT = [c for c in K.EXPORT_COLUMNS if c != "gold_ts"]


@query("export_scores", f"WITH {O.SCORED} SELECT {', '.join(_EXPORT)} FROM scored")
def export_scores(spark, folder):
    path = storage.scratch_path(spark, "scores")
    storage.export_scores(scored(spark, folder), path, K.EXPORT_COLUMNS, partition_by=["region"])
    return spark.read.parquet(path)


@query("project_available", f"WITH {O.SCORED} SELECT customer_id, region, vip_score FROM scored")
def project_available(spark, folder):
    return storage.project_available(scored(spark, folder), ["customer_id", "no_such_column", "region", "vip_score"])


@query(
    "write_raw",
    f"""WITH {O.FACTS}, k AS (SELECT {O.COMPLAINT} AS cid, * FROM conversations WHERE role = 'user')
    SELECT 'customers' AS table_name, count(*) AS n, count(DISTINCT customer_id) AS n_keys FROM raw
    UNION ALL SELECT 'complaints', count(*), count(DISTINCT conv_id) FROM k""",
)
def write_raw(spark, folder):
    base = storage.scratch_path(spark, "raw")
    tables = {"customers": (customer_raw(spark, folder), CUSTOMER_RAW), "complaints": (complaints(spark, folder), COMPLAINTS)}
    result = None
    for name, (df, schema) in tables.items():
        storage.write_table(df, f"{base}/{name}")
        per_key = storage.read_typed(spark, f"{base}/{name}", schema).groupBy("customer_id").agg(F.count("*").alias("c"))
        counts = per_key.agg(F.sum("c").alias("n"), F.count("*").alias("n_keys")).select(
            F.lit(name).alias("table_name"), "n", "n_keys"
        )
        result = counts if result is None else result.unionByName(counts)
    return result


@query("preview", f"WITH {O.FACTS} SELECT {O.RAW_COLUMNS} FROM raw ORDER BY customer_id, age LIMIT 20")
def preview(spark, folder):
    return customer_raw(spark, folder).orderBy("customer_id", "age").limit(20)


@query(
    "parse_requests",
    """SELECT event_id, user_id, try_cast(json_extract_string(props, '$.k') AS int) AS k,
    json_extract_string(props, '$.missing') AS missing FROM events""",
)
def parse_requests(spark, folder):
    return J.event_properties(read_table(spark, folder, "events"))


_REQUEST = (
    "customer_id, age, tenure_months, region, segment, avg_balance_6m, monthly_transactions, app_logins_30d, n_products, "
    "clv_score, n_complaints_3m, nps_score, days_since_last_contact"
)


@query("parse_request_bodies", f"WITH {O.SILVER} SELECT true AS is_readable, {_REQUEST} FROM silver")
def parse_request_bodies(spark, folder):
    """Customers as JSON bodies, parsed back to typed rows."""
    names = _REQUEST.replace(" ", "").split(",")
    bodies = silver(spark, folder).select(F.to_json(F.struct(*names)).alias("body"))
    return J.parse_requests(bodies).drop("last_complaint_text")


# ------------------------------------------------------------------------------------------- rules


@query(
    "enforce_types",
    """SELECT o_orderkey, try_cast(o_orderpriority AS int) AS age, try_cast(o_orderstatus AS double) AS avg_balance_6m,
    o_totalprice AS clv_score FROM orders""",
)
def enforce_types(spark, folder):
    """Columns that are partly or wholly unreadable as numbers become null instead of failing."""
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("age"),
        F.col("o_orderstatus").alias("avg_balance_6m"),
        F.col("o_totalprice").cast("string").alias("clv_score"),
    )
    return Q.enforce_types(orders)


@query(
    "fill_defaults",
    f"""WITH {O.FACTS} SELECT customer_id, age, coalesce(n_complaints_3m, 0) AS n_complaints_3m,
    coalesce(app_logins_30d, 0) AS app_logins_30d, coalesce(nps_score, 5) AS nps_score FROM raw""",
)
def fill_defaults(spark, folder):
    df = Q.fill_defaults(customer_raw(spark, folder))
    return df.select("customer_id", "age", "n_complaints_3m", "app_logins_30d", "nps_score")


@query(
    "drop_unkeyed",
    f"WITH {O.FACTS} SELECT customer_id, age, churn_label FROM raw WHERE customer_id IS NOT NULL AND churn_label IS NOT NULL",
)
def drop_unkeyed(spark, folder):
    return Q.drop_unkeyed(customer_raw(spark, folder)).select("customer_id", "age", "churn_label")


@query("stamp", "SELECT 'CLI-' || lpad(cast(c_custkey AS varchar), 7, '0') AS customer_id, true AS stamped FROM customer")
def stamp(spark, folder):
    """Whether every row bears both times of this run."""
    keyed = read_table(spark, folder, "customer").select(customer_key("c_custkey").alias("customer_id"))
    stamped = Q.stamp(Q.stamp(keyed, "silver_ts"), "gold_ts")
    recent = lambda c: F.col(c).isNotNull() & (F.col(c) > F.current_timestamp() - F.expr("INTERVAL 1 HOUR"))
    return stamped.select("customer_id", (recent("silver_ts") & recent("gold_ts")).alias("stamped"))


def _gold_columns(*names: str, sql: str | None = None):
    """Registers a query that shows derived gold columns beside the key."""
    key = names[0] if sql is None else sql
    query(key, f"WITH {O.GOLD} SELECT customer_id, {', '.join(names)} FROM gold")(
        lambda spark, folder: gold(spark, folder).select("customer_id", *names)
    )


_gold_columns("balance_per_tenure", "txn_per_product", "clv_per_month", sql="guarded_ratio")
_gold_columns("digital_engagement_score", sql="digital_engagement")
_gold_columns("complaint_intensity")
_gold_columns("nps_bucket")
_gold_columns("recency_risk")
_gold_columns("is_high_value")


@query("gold_layer", f"WITH {O.GOLD} SELECT * FROM gold")
def gold_layer(spark, folder):
    return gold(spark, folder)


@query("vip_score_linear", f"WITH {O.SCORED} SELECT customer_id, vip_score FROM scored")
def vip_score_linear(spark, folder):
    return R.add_vip(silver(spark, folder), "linear").select("customer_id", "vip_score")


@query("vip_tier", f"WITH {O.SCORED} SELECT customer_id, vip_classification FROM scored")
def vip_tier(spark, folder):
    return R.add_vip(silver(spark, folder), "linear").select("customer_id", "vip_classification")


@query("risk_level", f"WITH {O.SCORED} SELECT customer_id, churn_probability, churn_risk_level FROM scored")
def risk_level(spark, folder):
    return scored(spark, folder).select("customer_id", "churn_probability", "churn_risk_level")


@query("recommended_action", f"WITH {O.SCORED} SELECT customer_id, recommended_action FROM scored")
def recommended_action(spark, folder):
    return scored(spark, folder).select("customer_id", "recommended_action")


_TEXT_CUSTOMERS = "t AS (SELECT 'CLI-' || lpad(cast(conv_id AS varchar), 7, '0') AS customer_id, count(*) AS n_texts FROM conversations WHERE role = 'user' GROUP BY 1)"


@query(
    "fill_intent",
    f"""WITH {O.SILVER}, {_TEXT_CUSTOMERS}
    SELECT customer_id, coalesce({d('1.0')} / (n_texts + 1), {d('0.0')}) AS churn_intent_score FROM silver LEFT JOIN t USING (customer_id)""",
)
def fill_intent(spark, folder):
    """Customers without text get intent 0.0; the score here is a plain function of the text count."""
    counted = complaints(spark, folder).groupBy("customer_id").agg((F.lit(1.0) / (F.count("*") + 1)).alias("churn_intent_score"))
    return R.join_intent(silver(spark, folder), counted).select("customer_id", "churn_intent_score")


@query(
    "vip_score_capped",
    f"WITH {O.SCORED} SELECT customer_id, vip_capped AS vip_score, {O.vip_tier('vip_capped')} AS vip_classification FROM scored",
)
def vip_score_capped(spark, folder):
    return R.add_vip(silver(spark, folder), "capped").select("customer_id", "vip_score", "vip_classification")


@query("rule_churn_score", f"WITH {O.SCORED} SELECT customer_id, churn_probability FROM scored")
def rule_churn_score(spark, folder):
    return R.add_rule_score(silver(spark, folder)).select("customer_id", "churn_probability")


@query("top_risk_factors", f"WITH {O.SCORED} SELECT customer_id, factors AS top_risk_factors FROM scored")
def top_risk_factors(spark, folder):
    return R.add_rule_score(silver(spark, folder)).select("customer_id", F.array_join("top_risk_factors", "|").alias("top_risk_factors"))


_LAST_TEXT = f"""last_text AS (SELECT customer_id, arg_max(text, (day, cid)) AS last_complaint_text FROM (SELECT 'CLI-' || lpad(cast(conv_id AS varchar), 7, '0') AS customer_id,
  {O.COMPLAINT} AS cid, DATE '2000-08-01' - cast({O.COMPLAINT} % 90 + 1 AS int) AS day, text FROM conversations WHERE role = 'user') GROUP BY 1)"""


def _requests(spark, folder):
    last = complaints(spark, folder).groupBy("customer_id").agg(F.max(F.struct("complaint_date", "complaint_id", "complaint_text")).alias("m"))
    texts = last.select("customer_id", F.col("m.complaint_text").alias("last_complaint_text"))
    return silver(spark, folder).join(texts, "customer_id", "left")


_PROXY = O.half_up(f"least(churn_probability * {d('1.1')} + {d('0.05')}, {d('1.0')})", 4)


@query(
    "text_intent_proxy",
    f"""WITH {O.SCORED}, {_LAST_TEXT} SELECT customer_id, churn_probability,
    CASE WHEN len(last_complaint_text) > 0 THEN {_PROXY} END AS churn_intent_from_text
    FROM scored LEFT JOIN last_text USING (customer_id)""",
)
def text_intent_proxy(spark, folder):
    return R.score_requests(_requests(spark, folder)).select("customer_id", "churn_probability", "churn_intent_from_text")


@query(
    "score_requests",
    f"""WITH {O.SCORED}, {_LAST_TEXT} SELECT customer_id, churn_probability, churn_risk_level, recommended_action,
    {O.vip_tier('vip_capped')} AS vip_classification, vip_capped AS vip_score,
    CASE WHEN len(last_complaint_text) > 0 THEN {_PROXY} END AS churn_intent_from_text, factors AS top_risk_factors
    FROM scored LEFT JOIN last_text USING (customer_id)""",
)
def score_requests(spark, folder):
    """The whole answer of the scoring service for every customer."""
    answered = R.score_requests(_requests(spark, folder))
    return answered.select(
        "customer_id", "churn_probability", "churn_risk_level", "recommended_action", "vip_classification", "vip_score",
        "churn_intent_from_text", F.array_join("top_risk_factors", "|").alias("top_risk_factors"),
    )


def _bad_sql(segment_sql: str = _SEG_SQL) -> list[tuple[str, str]]:
    out = [("customer_id", "customer_id IS NULL")]
    for name, low, high in (
        ("age", 18, 100), ("tenure_months", 0, None), ("avg_balance_6m", 0, None), ("monthly_transactions", 0, None),
        ("app_logins_30d", 0, None), ("n_products", 1, 20), ("clv_score", 0, None), ("n_complaints_3m", 0, None),
        ("nps_score", 0, 10), ("days_since_last_contact", 0, None),
    ):
        upper = "" if high is None else f" OR {name} > {high}"
        out.append((name, f"{name} IS NULL OR {name} < {low}{upper}"))
    out.append(("region", "region IS NULL"))
    out.append(("segment", f"segment IS NULL OR segment NOT IN ({segment_sql})"))
    return out


_NARROW = "'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'"
_VIOLATIONS = "list_filter([" + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in _bad_sql(_NARROW)) + "], lambda x: x IS NOT NULL)"
_NARROW_SEGMENTS = TEST_SEGMENTS[:4]


@query(
    "batch_requests",
    f"""WITH {O.SCORED}, {_LAST_TEXT} SELECT customer_id, churn_probability, churn_risk_level, vip_capped AS vip_score,
    len(last_complaint_text) > 0 IS TRUE AS has_text, factors AS top_risk_factors FROM scored LEFT JOIN last_text USING (customer_id)
    WHERE segment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') AND age BETWEEN 18 AND 100 AND tenure_months >= 0 AND avg_balance_6m >= 0
    AND monthly_transactions >= 0 AND app_logins_30d >= 0 AND n_products BETWEEN 1 AND 20 AND clv_score >= 0 AND n_complaints_3m >= 0
    AND nps_score BETWEEN 0 AND 10 AND days_since_last_contact >= 0 AND region IS NOT NULL""",
)
def batch_requests(spark, folder):
    """Bodies with a list of customers: parsed, validated, the invalid ones set aside, the rest scored."""
    rows = _requests(spark, folder)
    names = [*_REQUEST.replace(" ", "").split(","), "last_complaint_text"]
    body = F.to_json(F.struct(F.collect_list(F.struct(*names)).alias("customers"))).alias("body")
    bodies = rows.groupBy(S.hash_bucket("customer_id", 1 << 20).alias("request")).agg(body)
    valid, _ = Q.split_valid(Q.validate_rows(J.parse_batch_requests(bodies), _NARROW_SEGMENTS))
    answered = R.score_requests(valid)
    return answered.select(
        "customer_id", "churn_probability", "churn_risk_level", "vip_score",
        F.coalesce(F.length("last_complaint_text") > 0, F.lit(False)).alias("has_text"),
        F.array_join("top_risk_factors", "|").alias("top_risk_factors"),
    )


@query(
    "validate_rows",
    f"""WITH {O.FACTS} SELECT customer_id, age, array_to_string({_VIOLATIONS}, '|') AS violations,
    len({_VIOLATIONS}) = 0 AS is_valid FROM raw""",
)
def validate_rows(spark, folder):
    """Checks of the raw table against a domain that leaves one segment out, so each kind fires."""
    checked = Q.validate_rows(customer_raw(spark, folder), _NARROW_SEGMENTS)
    return checked.select("customer_id", "age", F.array_join("violations", "|").alias("violations"), "is_valid")


@query(
    "validation_summary",
    f"""WITH {O.FACTS} SELECT check_name, count(*) AS n_violations
    FROM (SELECT unnest({_VIOLATIONS}) AS check_name FROM raw) GROUP BY 1""",
)
def validation_summary(spark, folder):
    return Q.validation_summary(Q.validate_rows(customer_raw(spark, folder), _NARROW_SEGMENTS))


@query("format_customer_id", "SELECT c_custkey, 'CLI-' || lpad(cast(c_custkey AS varchar), 7, '0') AS customer_id FROM customer")
def format_customer_id(spark, folder):
    return read_table(spark, folder, "customer").select("c_custkey", customer_key("c_custkey").alias("customer_id"))


_CLV = f"greatest(avg_balance_6m * {d('0.015')} + monthly_transactions * {d('500.0')} + n_products * {d('2000.0')}, {d('0.0')})"


@query(
    "clv_formula",
    f"WITH {O.SILVER} SELECT customer_id, CASE WHEN avg_balance_6m IS NULL THEN NULL ELSE {O.half_up(_CLV, 2)} END AS clv FROM silver",
)
def clv_formula(spark, folder):
    return silver(spark, folder).select("customer_id", R.clv_formula().alias("clv"))


@query(
    "days_to_date",
    f"""WITH {O.SILVER} SELECT customer_id, strftime(DATE '2000-08-01' - days_since_last_contact, '%Y-%m-%d') AS contact_text,
    cast(date_diff('day', DATE '2000-08-01' - days_since_last_contact, DATE '2000-08-01') AS int) AS days_back FROM silver""",
)
def days_to_date(spark, folder):
    as_of = F.lit("2000-08-01").cast("date")
    text = F.date_format(F.date_sub(as_of, F.col("days_since_last_contact")), "yyyy-MM-dd")
    return (
        silver(spark, folder)
        .select("customer_id", text.alias("contact_text"))
        .withColumn("days_back", F.datediff(as_of, F.to_date("contact_text", "yyyy-MM-dd")))
    )


_COMMON_WORDS = ("the ", " und ", "tion", "el ")


def _any_sql(column: str, words) -> str:
    return " OR ".join(f"contains(lower({column}), '{w}')" for w in words)


@query(
    "keyword_flag",
    f"SELECT doc_id, {_any_sql('text', K.LEAVING_KEYWORDS)} AS leaving, {_any_sql('text', _COMMON_WORDS)} AS common FROM documents",
)
def keyword_flag(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id", S.contains_any("text", K.LEAVING_KEYWORDS).alias("leaving"), S.contains_any("text", _COMMON_WORDS).alias("common")
    )


_BALANCE = "CASE WHEN saldo = 0 THEN 'nulo' WHEN saldo < 50000 THEN 'bajo' WHEN saldo < 120000 THEN 'medio' WHEN saldo < 200000 THEN 'alto' ELSE 'muy alto' END"
_SALARY = "CASE WHEN salario_estimado < 30000 THEN 'bajo' WHEN salario_estimado < 60000 THEN 'medio' WHEN salario_estimado < 90000 THEN 'alto' ELSE 'muy alto' END"
_CREDIT = "CASE WHEN score_credito < 450 THEN 'muy bajo' WHEN score_credito < 600 THEN 'bajo' WHEN score_credito < 750 THEN 'medio' ELSE 'alto' END"


@query("band_balance", f"WITH {O.DEMOGRAPHIC} SELECT customer_id, saldo, {_BALANCE} AS nivel FROM demographic")
def band_balance(spark, folder):
    return demographic(spark, folder).select("customer_id", "saldo", X.balance_level("saldo").alias("nivel"))


@query("band_salary", f"WITH {O.DEMOGRAPHIC} SELECT customer_id, salario_estimado, {_SALARY} AS nivel FROM demographic")
def band_salary(spark, folder):
    return demographic(spark, folder).select("customer_id", "salario_estimado", X.salary_level("salario_estimado").alias("nivel"))


@query("band_credit", f"WITH {O.DEMOGRAPHIC} SELECT customer_id, score_credito, {_CREDIT} AS nivel FROM demographic")
def band_credit(spark, folder):
    return demographic(spark, folder).select("customer_id", "score_credito", X.credit_level("score_credito").alias("nivel"))


def _si(flag: str) -> str:
    return f"CASE WHEN {flag} <> 0 THEN 'si' ELSE 'no' END"


@query(
    "row_to_text",
    f"""WITH {O.DEMOGRAPHIC} SELECT customer_id, concat_ws(', ', 'edad: ' || edad, 'genero: ' || genero, 'pais: ' || pais,
    'antiguedad: ' || "antiguedad_años" || ' años', 'saldo: ' || {_BALANCE}, 'productos: ' || num_productos,
    'tarjeta credito: ' || {_si('tiene_tarjeta')}, 'miembro activo: ' || {_si('miembro_activo')}, 'salario: ' || {_SALARY},
    'quejas: ' || CASE WHEN quejas_recibidas = 0 THEN 'ninguna' ELSE cast(quejas_recibidas AS varchar) END,
    'usa app movil: ' || {_si('uso_app_movil')}, 'score credito: ' || {_CREDIT}) AS texto FROM demographic""",
)
def row_to_text(spark, folder):
    return demographic(spark, folder).select("customer_id", X.labelled_row_text().alias("texto"))


def _one(c: str) -> str:
    return f"format('{{:.1f}}', {c})"


def _whole(c: str) -> str:
    return f"cast(cast({c} AS bigint) AS varchar)"


@query(
    "row_to_narrative",
    f"""WITH {O.BEHAVIOUR} SELECT customer_id, concat_ws(' ',
    'Cliente con ' || {_one('antiguedad_anos')} || ' años de antigüedad.',
    CASE WHEN dias_sin_app > 45 THEN 'Sin uso de app móvil hace ' || {_whole('dias_sin_app')} || ' días (inactividad severa).'
      WHEN dias_sin_app > 20 THEN 'Baja actividad digital, sin app hace ' || {_whole('dias_sin_app')} || ' días.'
      ELSE 'Activo en app móvil (último acceso hace ' || {_whole('dias_sin_app')} || ' días).' END,
    CASE WHEN var_saldo_pct < -30 THEN 'Reducción severa de saldo (' || {_whole('var_saldo_pct')} || '% en 3 meses).'
      WHEN var_saldo_pct < -10 THEN 'Disminución moderada de saldo (' || {_whole('var_saldo_pct')} || '%).'
      WHEN var_saldo_pct > 10 THEN 'Saldo en crecimiento positivo (' || {_whole('var_saldo_pct')} || '%).'
      ELSE 'Saldo estable (' || {_whole('var_saldo_pct')} || '%).' END,
    CASE WHEN var_transacciones_pct < -30 THEN 'Frecuencia transaccional cayó ' || {_whole('abs(var_transacciones_pct)')} || '% vs histórico.'
      WHEN var_transacciones_pct > 10 THEN 'Alta actividad transaccional, creció ' || {_whole('var_transacciones_pct')} || '%.'
      ELSE 'Frecuencia transaccional estable.' END,
    CASE WHEN num_productos = 1 THEN 'Cliente con un único producto activo (baja vinculación).'
      WHEN num_productos >= 4 THEN 'Alta vinculación: ' || num_productos || ' productos activos.'
      ELSE 'Vinculación media: ' || num_productos || ' productos activos.' END,
    CASE WHEN reclamos_6m > 2 THEN 'Registra ' || reclamos_6m || ' reclamos en los últimos 6 meses.'
      WHEN reclamos_6m = 0 THEN 'Sin reclamos recientes.' END,
    CASE WHEN score_satisfaccion < 4 THEN 'Score de satisfacción bajo: ' || {_one('score_satisfaccion')} || '/10.'
      WHEN score_satisfaccion > 7 THEN 'Alta satisfacción declarada: ' || {_one('score_satisfaccion')} || '/10.' END) AS perfil
    FROM behaviour""",
)
def row_to_narrative(spark, folder):
    return behaviour(spark, folder).select("customer_id", X.narrative().alias("perfil"))


def _add(w: str, p: str) -> str:
    return f" + CASE WHEN {p} THEN {d(w)} ELSE {d('0.0')} END"


_DEMO = (
    d("0.15") + _add("0.35", "quejas_recibidas >= 2") + _add("0.20", "miembro_activo = 0") + _add("0.15", "num_productos >= 3")
    + _add("0.10", "saldo = 0") + _add("0.10", "edad > 55") + _add("0.08", "pais = 'Alemania'") + _add("0.08", '"antiguedad_años" <= 1')
    + _add("0.12", "score_credito < 450") + _add("-0.10", "uso_app_movil = 1") + _add("-0.05", "tiene_tarjeta = 1")
    + _add("-0.05", "salario_estimado > 80000")
)


@query(
    "rule_churn_probability",
    f"WITH {O.DEMOGRAPHIC} SELECT customer_id, least(greatest({_DEMO}, {d('0.02')}), {d('0.97')}) AS prob FROM demographic",
)
def rule_churn_probability(spark, folder):
    return demographic(spark, folder).select("customer_id", R.demographic_probability().alias("prob"))


@query(
    "network_band_action",
    f"""WITH {O.SCORED} SELECT customer_id,
    CASE WHEN churn_probability >= {d('0.7')} THEN 'ALTO RIESGO' WHEN churn_probability >= {d('0.4')} THEN 'RIESGO MEDIO' ELSE 'BAJO RIESGO' END AS riesgo,
    CASE WHEN churn_probability >= {d('0.7')} THEN 'Activar retención VIP inmediata' WHEN churn_probability >= {d('0.4')} THEN 'Campaña preventiva digital' ELSE 'Monitoreo estándar' END AS accion
    FROM scored""",
)
def network_band_action(spark, folder):
    p = "churn_probability"
    return scored(spark, folder).select(
        "customer_id", S.band(p, K.NETWORK_CUTS, K.NETWORK_LABELS).alias("riesgo"), S.band(p, K.NETWORK_CUTS, K.NETWORK_ACTIONS).alias("accion")
    )


@query(
    "hybrid_band_action",
    f"""WITH {O.SCORED} SELECT customer_id,
    CASE WHEN churn_probability > {d('0.75')} THEN 'ALTO' WHEN churn_probability > {d('0.40')} THEN 'MEDIO' ELSE 'BAJO' END AS riesgo,
    CASE WHEN churn_probability > {d('0.75')} THEN 'Retención VIP inmediata' WHEN churn_probability > {d('0.40')} THEN 'Campaña preventiva' ELSE 'Monitoreo estándar' END AS accion
    FROM scored""",
)
def hybrid_band_action(spark, folder):
    p = "churn_probability"
    return scored(spark, folder).select(
        "customer_id",
        S.band(p, K.HYBRID_CUTS, K.HYBRID_LABELS, closed="right").alias("riesgo"),
        S.band(p, K.HYBRID_CUTS, K.HYBRID_ACTIONS, closed="right").alias("accion"),
    )


@query(
    "percent_view",
    f"""WITH {O.SCORED} SELECT customer_id, cast(CASE WHEN churn_probability > {d('1.0')} - churn_probability THEN 1 ELSE 0 END AS int) AS prediccion,
    CASE WHEN churn_probability > {d('1.0')} - churn_probability THEN 'CHURN' ELSE 'NO CHURN' END AS etiqueta,
    {O.half_up(f"({d('1.0')} - churn_probability) * {d('100.0')}", 2)} AS prob_no_churn,
    {O.half_up(f"churn_probability * {d('100.0')}", 2)} AS prob_churn FROM scored""",
)
def percent_view(spark, folder):
    return R.percent_view(scored(spark, folder), "churn_probability")


@query(
    "clip_round",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {O.half_up(f"least(greatest(l_extendedprice * (1 - l_discount), {d('1000.0')}), {d('50000.0')})", 2)} AS net FROM lineitem""",
)
def clip_round(spark, folder):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.round_half_up(S.clip(net, 1000.0, 50000.0), 2).alias("net")
    )


@query(
    "threshold_predict",
    f"WITH {O.SCORED} SELECT customer_id, cast(churn_probability >= {d('0.5')} AS int) AS prediction FROM scored",
)
def threshold_predict(spark, folder):
    return scored(spark, folder).select("customer_id", M.threshold_predict("churn_probability").alias("prediction"))


# ------------------------------------------------------------------------------------------- joins


@query("dedup_customers", f"WITH {O.SILVER} SELECT customer_id, age, ingestion_ts FROM latest")
def dedup_customers(spark, folder):
    latest = Q.dedup_latest(customer_raw(spark, folder), "customer_id", "ingestion_ts", ["age"])
    return latest.select("customer_id", "age", "ingestion_ts")


@query("silver_layer", f"WITH {O.SILVER} SELECT * FROM silver")
def silver_layer(spark, folder):
    return silver(spark, folder)


@query(
    "union_classes",
    f"WITH {O.BEHAVIOUR} SELECT * FROM behaviour",
)
def union_classes(spark, folder):
    rows = behaviour(spark, folder)
    return splits.union_classes(rows.where("churn = 1"), rows.where("churn = 0"), "customer_id")


@query(
    "expand_complaints",
    f"""WITH {O.SILVER}, x AS (SELECT customer_id, churn_label, n_complaints_3m, unnest(generate_series(1, n_complaints_3m)) AS item FROM silver WHERE n_complaints_3m > 0)
    SELECT customer_id, churn_label, cast(item AS int) AS item,
    strftime(DATE '2000-08-01' - cast((item * 29) % 90 + 1 AS int), '%Y-%m-%d') AS complaint_date,
    CASE item % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'call_center' WHEN 2 THEN 'email' ELSE 'sucursal' END AS channel FROM x""",
)
def expand_complaints(spark, folder):
    """One row for each counted complaint."""
    rows = silver(spark, folder).select("customer_id", "churn_label", "n_complaints_3m")
    items = splits.expand_counts(rows, "customer_id", "n_complaints_3m")
    channel = F.element_at(F.array(*[F.lit(c) for c in K.COMPLAINT_CHANNELS]), F.col("item") % 4 + 1)
    return items.drop("n_complaints_3m").withColumns(
        {
            "complaint_date": F.date_format(F.date_sub(F.lit("2000-08-01").cast("date"), (F.col("item") * 29) % 90 + 1), "yyyy-MM-dd"),
            "channel": channel,
        }
    )


@query("build_customer_snapshot", f"WITH {O.FACTS} SELECT {O.RAW_COLUMNS} FROM raw")
def build_customer_snapshot(spark, folder):
    return customer_raw(spark, folder)


_PROFILE = (
    f"""WITH {O.SCORED}, k AS (SELECT {O.COMPLAINT} AS cid, 'CLI-' || lpad(cast(conv_id AS varchar), 7, '0') AS customer_id FROM conversations WHERE role = 'user'),
    dated AS (SELECT *, DATE '2000-08-01' - cast(cid % 90 + 1 AS int) AS day FROM k),
    t AS (SELECT customer_id, count(*) AS n_texts, max(day) AS last_text_date, arg_max(cid, (day, cid)) AS last_cid FROM dated GROUP BY 1)
    SELECT customer_id, segment, churn_probability, churn_risk_level, vip_classification, coalesce(n_texts, 0) AS n_texts, last_text_date,
    CASE last_cid % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'call_center' WHEN 2 THEN 'email' WHEN 3 THEN 'sucursal' END AS last_text_channel
    FROM scored LEFT JOIN t USING (customer_id)"""
)


@query("customer_profile", _PROFILE)
def customer_profile(spark, folder):
    return R.customer_profile(_rated(spark, folder), complaints(spark, folder))


def _rated(spark, folder):
    return scored(spark, folder).select("customer_id", "segment", "churn_probability", "churn_risk_level", "vip_classification")


@query("customer_profile_one", _PROFILE + " WHERE customer_id = 'CLI-0000042'")
def customer_profile_one(spark, folder):
    """The profile of one customer; the key is filtered before any join of the profile."""
    return R.customer_profile(_rated(spark, folder), complaints(spark, folder), "CLI-0000042")
