"""Aggregates, splits, evaluation and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.operators import metrics as M
from ebbwatch.operators import quality as Q
from ebbwatch.operators import reports as P
from ebbwatch.operators import splits
from ebbwatch.functions.scalar import round_half_up
from ebbwatch.plans import oracle as O
from ebbwatch.plans.catalog_tables import TEST_SEGMENTS, _bad_sql
from ebbwatch.plans.registry import query, scored, silver, six
from ebbwatch.sources.snapshot import behaviour, complaints, customer_key, customer_raw
from ebbwatch.sources.storage import read_table, spread

d = O.d

# ------------------------------------------------------------------------------------- aggregates


@query(
    "quality_counts",
    f"""WITH {O.SILVER} SELECT (SELECT count(*) FROM raw) AS rows_in, count(*) AS rows_kept,
    (SELECT count(*) FROM raw) - count(*) AS rows_dropped FROM silver""",
)
def quality_counts(spark, folder):
    return Q.quality_counts(customer_raw(spark, folder))


def _share(column: str, table: str = "scored", name: str | None = None) -> str:
    name = name or column
    return (
        f"SELECT {column} AS {name}, count(*) AS n, count(*) * {d('100.0')} / (sum(count(*)) OVER ())::double AS percent "
        f"FROM {table} GROUP BY 1"
    )


@query("risk_distribution", f"WITH {O.SCORED} {_share('churn_risk_level')}")
def risk_distribution(spark, folder):
    return P.distribution(scored(spark, folder), "churn_risk_level", "churn_risk_level").orderBy(F.desc("n"))


@query("vip_distribution", f"WITH {O.SCORED} {_share('vip_classification')}")
def vip_distribution(spark, folder):
    return P.distribution(scored(spark, folder), "vip_classification", "vip_classification").orderBy(F.desc("n"))


@query(
    "executive_summary",
    f"""WITH {O.SCORED}, c AS (SELECT 'total' AS section, 'all' AS value, count(*) AS n FROM scored
      UNION ALL SELECT 'risk', churn_risk_level, count(*) FROM scored GROUP BY 2
      UNION ALL SELECT 'vip', vip_classification, count(*) FROM scored GROUP BY 2)
    SELECT section, value, n, n * {d('100.0')} / (sum(n) OVER (PARTITION BY section))::double AS percent FROM c""",
)
def executive_summary(spark, folder):
    return P.executive_summary(scored(spark, folder))


@query("class_balance", f"WITH {O.SILVER} {_share('churn_label', 'silver', 'label')}")
def class_balance(spark, folder):
    return M.class_balance(silver(spark, folder), "churn_label")


@query(
    "label_means",
    f"""WITH {O.SILVER} SELECT churn_label AS label, count(*) AS n, {O.six("avg(age)")} AS mean_age,
    {O.six('avg(tenure_months)')} AS mean_tenure_months, {O.six('avg(n_products)')} AS mean_n_products,
    {O.six('avg(nps_score)')} AS mean_nps_score FROM silver GROUP BY 1""",
)
def label_means(spark, folder):
    names = ["age", "tenure_months", "n_products", "nps_score"]
    means = P.label_means(silver(spark, folder), "churn_label", names)
    return means.select("label", "n", *[six(f"mean_{c}").alias(f"mean_{c}") for c in names])


_DESCRIBED = ("age", "tenure_months", "avg_balance_6m", "monthly_transactions", "n_products", "clv_score", "nps_score", "days_since_last_contact")


def _describe_sql(c: str) -> str:
    v = f"{c}::double"
    return (
        f"SELECT '{c}' AS feature, count({c}) AS n, {O.half_up(f'avg({v})', 3)} AS mean, {O.half_up(f'stddev_samp({v})', 3)} AS std, "
        f"min({v}) AS min, max({v}) AS max, {O.half_up(f'quantile_cont({v}, 0.25)', 3)} AS q25, "
        f"{O.half_up(f'quantile_cont({v}, 0.5)', 3)} AS q50, {O.half_up(f'quantile_cont({v}, 0.75)', 3)} AS q75 FROM silver"
    )


@query("describe", f"WITH {O.SILVER} " + " UNION ALL ".join(_describe_sql(c) for c in _DESCRIBED))
def describe(spark, folder):
    stats = P.describe(silver(spark, folder), _DESCRIBED)
    rounded = [round_half_up(c, 3).alias(c) for c in ("mean", "std", "q25", "q50", "q75")]
    return stats.select("feature", "n", "min", "max", *rounded)


@query(
    "class_histogram",
    f"""WITH {O.BEHAVIOUR}, e AS (SELECT churn AS label, min(dias_sin_app) AS low, max(dias_sin_app) AS high, count(*) AS class_n FROM behaviour GROUP BY 1),
    b AS (SELECT label, low, high, class_n, (high - low) / {d('30.0')} AS width,
      cast(CASE WHEN high > low THEN least(floor((dias_sin_app - low) / ((high - low) / {d('30.0')})), 29) ELSE 0 END AS int) AS bin
      FROM behaviour JOIN e ON churn = label)
    SELECT label, bin, count(*) AS n, max(low) + bin * max(width) AS left_edge,
    CASE WHEN max(width) > 0 THEN count(*)::double / (max(class_n) * max(width)) END AS density FROM b GROUP BY label, bin""",
)
def class_histogram(spark, folder):
    return P.class_histogram(behaviour(spark, folder), "churn", "dias_sin_app", bins=30)


@query(
    "sample_rows",
    f"WITH {O.SILVER} SELECT customer_id, age, region FROM silver ORDER BY md5(customer_id), customer_id LIMIT 25",
)
def sample_rows(spark, folder):
    return splits.sample_rows(silver(spark, folder).select("customer_id", "age", "region"), "customer_id", 25)


_CONFUSION = f"""conf AS (SELECT count(CASE WHEN churn_label = 1 AND p = 1 THEN 1 END) AS tp, count(CASE WHEN churn_label = 0 AND p = 1 THEN 1 END) AS fp,
  count(CASE WHEN churn_label = 0 AND p = 0 THEN 1 END) AS tn, count(CASE WHEN churn_label = 1 AND p = 0 THEN 1 END) AS fn
  FROM (SELECT churn_label, CASE WHEN churn_probability >= {d('0.5')} THEN 1 ELSE 0 END AS p FROM scored))"""


def _confusion(spark, folder):
    rows = scored(spark, folder).withColumn("prediction", M.threshold_predict("churn_probability"))
    return M.confusion(rows, "churn_label", "prediction")


@query(
    "business_impact",
    f"""WITH {O.SCORED}, {_CONFUSION}, s AS (SELECT cast(floor(tp * ({d('50000.0')} / (tp + fp + tn + fn))) AS bigint) AS tp_portfolio,
      cast(floor(fn * ({d('50000.0')} / (tp + fp + tn + fn))) AS bigint) AS fn_portfolio,
      cast(floor(fp * ({d('50000.0')} / (tp + fp + tn + fn))) AS bigint) AS fp_portfolio FROM conf),
    r AS (SELECT *, cast(floor(tp_portfolio * {d('0.25')}) AS bigint) AS retained FROM s)
    SELECT *, retained * 3000000 AS income, (retained * 3000000 - {d('200000000.0')}) / {d('200000000.0')} AS roi FROM r""",
)
def business_impact(spark, folder):
    return M.business_impact(_confusion(spark, folder))


@query(
    "positive_weight",
    f"""WITH {O.SILVER} SELECT count(CASE WHEN churn_label = 0 THEN 1 END) AS n_neg, count(CASE WHEN churn_label = 1 THEN 1 END) AS n_pos,
    count(CASE WHEN churn_label = 0 THEN 1 END)::double / count(CASE WHEN churn_label = 1 THEN 1 END) AS weight_pos, {d('1.0')} AS weight_neg FROM silver""",
)
def positive_weight(spark, folder):
    return M.positive_weight(silver(spark, folder), "churn_label")


# ----------------------------------------------------------------------------------------- splits

_HEX = "cast('0x' || substr(md5({}), 1, 8) AS bigint)"


@query(
    "split_80_20",
    f"""WITH k AS (SELECT 'CLI-' || lpad(cast(c_custkey AS varchar), 7, '0') AS customer_id FROM customer)
    SELECT customer_id, CASE WHEN {_HEX.format('customer_id')} % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM k""",
)
def split_80_20(spark, folder):
    keys = read_table(spark, folder, "customer").select(customer_key("c_custkey").alias("customer_id"))
    return splits.split_by_hash(keys, "customer_id")


_RANKED = "r AS (SELECT customer_id, churn_label, row_number() OVER (PARTITION BY churn_label ORDER BY md5(customer_id), customer_id) AS pos, count(*) OVER (PARTITION BY churn_label) AS n FROM silver)"


@query(
    "split_stratified_80_20",
    f"""WITH {O.SILVER}, {_RANKED} SELECT customer_id, churn_label, CASE WHEN pos <= floor(n * {d('0.8')}) THEN 'train' ELSE 'test' END AS part FROM r""",
)
def split_stratified_80_20(spark, folder):
    rows = silver(spark, folder).select("customer_id", "churn_label")
    return splits.split_stratified(rows, "customer_id", "churn_label", splits.TWO_WAY)


@query(
    "split_70_15_15",
    f"""WITH {O.SILVER}, {_RANKED} SELECT customer_id, churn_label,
    CASE WHEN pos <= floor(n * ({d('0.85')} * ({d('1.0')} - {d('0.176')}))) THEN 'train' WHEN pos <= floor(n * {d('0.85')}) THEN 'validation' ELSE 'test' END AS part FROM r""",
)
def split_70_15_15(spark, folder):
    rows = silver(spark, folder).select("customer_id", "churn_label")
    return splits.split_stratified(rows, "customer_id", "churn_label", splits.THREE_WAY)


@query(
    "kfold",
    f"""WITH {O.SILVER} SELECT cast({_HEX.format("'fold:' || customer_id")} % 5 AS int) AS fold, count(*) AS n,
    count(CASE WHEN churn_label = 1 THEN 1 END) AS n_churn FROM silver GROUP BY 1""",
)
def kfold(spark, folder):
    folded = splits.add_fold(silver(spark, folder), "customer_id", 5)
    return folded.groupBy("fold").agg(F.count("*").alias("n"), F.count_if(F.col("churn_label") == 1).alias("n_churn"))


# ------------------------------------------------------------------------------------- evaluation


@query("confusion", f"WITH {O.SCORED}, {_CONFUSION} SELECT * FROM conf")
def confusion(spark, folder):
    return _confusion(spark, folder)


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN {d('0.0')} ELSE ({a})::double / ({b})::double END"


_REPORT = f"""p AS (SELECT tp, fp, tn, fn, {_div('tn', 'tn + fn')} AS p0, {_div('tn', 'tn + fp')} AS r0, {_div('tp', 'tp + fp')} AS p1,
    {_div('tp', 'tp + fn')} AS r1, {_div('tp + tn', 'tp + tn + fp + fn')} AS acc, tn + fp AS n0, tp + fn AS n1 FROM conf),
  f AS (SELECT *, {_div(f"p0 * r0 * {d('2.0')}", 'p0 + r0')} AS f0, {_div(f"p1 * r1 * {d('2.0')}", 'p1 + r1')} AS f1 FROM p)"""


@query(
    "class_report",
    f"""WITH {O.SCORED}, {_CONFUSION}, {_REPORT}
    SELECT '0' AS class_name, p0 AS precision, r0 AS recall, f0 AS f1, n0 AS support FROM f
    UNION ALL SELECT '1', p1, r1, f1, n1 FROM f
    UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM f
    UNION ALL SELECT 'macro avg', (p0 + p1) / {d('2.0')}, (r0 + r1) / {d('2.0')}, (f0 + f1) / {d('2.0')}, n0 + n1 FROM f
    UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM f""",
)
def class_report(spark, folder):
    return M.class_report(_confusion(spark, folder))


_AUC = f"""g AS (SELECT churn_probability AS s, count(CASE WHEN churn_label = 1 THEN 1 END) AS pos, count(CASE WHEN churn_label = 0 THEN 1 END) AS neg FROM scored GROUP BY 1),
  l AS (SELECT *, coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double AS pb,
    coalesce(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double AS nb,
    (sum(pos) OVER ())::double AS pa, (sum(neg) OVER ())::double AS na FROM g)"""
_AUC_VALUE = f"sum(neg * (pb + pos * {d('0.5')})) / (max(pa) * max(na))"


@query("auc_roc", f"WITH {O.SCORED}, {_AUC} SELECT cast(max(pa) AS bigint) AS n_pos, cast(max(na) AS bigint) AS n_neg, {O.six(_AUC_VALUE)} AS auc_roc FROM l")
def auc_roc(spark, folder):
    return M.auc_roc(scored(spark, folder), "churn_label", "churn_probability").withColumn("auc_roc", six("auc_roc"))


@query("roc_points", f"WITH {O.SCORED}, {_AUC} SELECT s AS threshold, (nb + neg) / na AS fpr, (pb + pos) / pa AS tpr FROM l")
def roc_points(spark, folder):
    return M.roc_points(scored(spark, folder), "churn_label", "churn_probability")


@query("gini", f"WITH {O.SCORED}, {_AUC} SELECT {O.six(f'({_AUC_VALUE}) * 2.0::double - 1.0::double')} AS gini FROM l")
def gini(spark, folder):
    return M.gini(scored(spark, folder), "churn_label", "churn_probability").select(six("gini").alias("gini"))


@query(
    "log_loss",
    f"""WITH {O.SCORED}, c AS (SELECT churn_label, churn_probability AS s, greatest(least(churn_probability, {d('1.0')} - 1e-15::double), 1e-15::double) AS p FROM scored)
    SELECT count(*) AS n, {O.six(f"avg(-ln(CASE WHEN churn_label = 1 THEN p ELSE {d('1.0')} - p END))")} AS log_loss,
    count(CASE WHEN churn_label = CASE WHEN s >= {d('0.5')} THEN 1 ELSE 0 END THEN 1 END)::double / count(*) AS accuracy FROM c""",
)
def log_loss(spark, folder):
    return M.log_loss(scored(spark, folder), "churn_label", "churn_probability").withColumn("log_loss", six("log_loss"))


@query(
    "metric_goals",
    f"""WITH {O.SCORED}, {_CONFUSION}, {_REPORT}, {_AUC}, v AS (SELECT 'auc_roc' AS metric, {O.six(_AUC_VALUE)} AS value, {d('0.85')} AS goal FROM l
      UNION ALL SELECT 'recall', r1, {d('0.75')} FROM f UNION ALL SELECT 'precision', p1, {d('0.65')} FROM f UNION ALL SELECT 'f1', f1, {d('0.70')} FROM f)
    SELECT metric, value, goal, value > goal AS reached FROM v""",
)
def metric_goals(spark, folder):
    values = M.binary_metrics(scored(spark, folder), "churn_label", "churn_probability")
    rounded = F.when(F.col("metric") == "auc_roc", six("value")).otherwise(F.col("value"))
    return M.metric_goals(values.withColumn("value", rounded))


@query(
    "auc_pr",
    f"""WITH {O.SCORED}, {_AUC}, c AS (SELECT pos, pa, (pb + pos) / (pb + pos + nb + neg) AS pr, CASE WHEN pb + nb > 0 THEN pb / (pb + nb) END AS before FROM l)
    SELECT {O.six(f"sum(pos / pa * (pr + coalesce(before, pr)) / {d('2.0')})")} AS auc_pr FROM c""",
)
def auc_pr(spark, folder):
    return M.auc_pr(scored(spark, folder), "churn_label", "churn_probability").select(six("auc_pr").alias("auc_pr"))


@query(
    "ks_statistic",
    f"""WITH {O.SCORED}, {_AUC}, g2 AS (SELECT s AS threshold, abs((pb + pos) / pa - (nb + neg) / na) AS ks FROM l)
    SELECT ks, threshold FROM g2 ORDER BY ks DESC, threshold DESC LIMIT 1""",
)
def ks_statistic(spark, folder):
    return M.ks_statistic(scored(spark, folder), "churn_label", "churn_probability")


@query(
    "lift_table",
    f"""WITH {O.SCORED}, t AS (SELECT churn_label, ntile(10) OVER (ORDER BY churn_probability DESC, md5(customer_id), customer_id) AS tile FROM scored),
    a AS (SELECT count(CASE WHEN churn_label = 1 THEN 1 END)::double / count(*)::double AS overall FROM t)
    SELECT cast(tile AS int) AS tile, count(*) AS n, count(CASE WHEN churn_label = 1 THEN 1 END) AS n_churn,
    count(CASE WHEN churn_label = 1 THEN 1 END)::double / count(*)::double AS churn_rate,
    (count(CASE WHEN churn_label = 1 THEN 1 END)::double / count(*)::double) / max(overall) AS lift FROM t CROSS JOIN a GROUP BY tile""",
)
def lift_table(spark, folder):
    return M.lift_table(scored(spark, folder), "customer_id", "churn_label", "churn_probability")


# ---------------------------------------------------------------------------------------- reports


@query(
    "risk_summary",
    f"""WITH {O.SCORED} SELECT region, segment, cast(grouping(region, segment) AS int) AS level, count(*) AS n,
    count(CASE WHEN churn_risk_level = 'ALTO' THEN 1 END) AS n_high,
    sum(cast(round(churn_probability * 10000) AS bigint))::double / {d('10000.0')} / count(*) AS mean_score FROM scored GROUP BY ROLLUP (region, segment)""",
)
def risk_summary(spark, folder):
    return P.risk_summary(scored(spark, folder))


@query(
    "vip_portfolio",
    f"""WITH {O.SCORED} SELECT customer_id, region, segment, vip_classification, clv_score,
    rank() OVER (PARTITION BY region ORDER BY clv_score DESC) AS clv_rank FROM scored WHERE vip_classification IN ('PLATINUM', 'GOLD')""",
)
def vip_portfolio(spark, folder):
    return P.vip_portfolio(scored(spark, folder))


@query(
    "retention_alerts",
    f"""WITH {O.SCORED} SELECT customer_id, region, churn_probability, churn_risk_level, recommended_action, clv_score, vip_classification
    FROM scored WHERE churn_risk_level IN ('ALTO', 'MEDIO') AND is_high_value = 1""",
)
def retention_alerts(spark, folder):
    return P.retention_alerts(scored(spark, folder))


@query(
    "anonymize",
    r"""SELECT sha256('ebb' || cast(doc_id AS varchar)) AS doc_id,
    regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+', '<mail>', 'g'), '[0-9]', '#', 'g') AS text FROM documents""",
)
def anonymize(spark, folder):
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "text"))
    return P.anonymize(docs, "doc_id", "text", salt="ebb")


_EXPECT = [(f"valid:{n}", p) for n, p in _bad_sql()] + [
    (f"not_null:{c}", f"{c} IS NULL") for c, _, _ in K.REQUEST_RANGES
]


@query(
    "quality_expectations",
    f"""WITH {O.FACTS}, x AS ("""
    + " UNION ALL ".join(f"SELECT count(*) AS n_rows, '{n}' AS expectation, count(CASE WHEN {p} THEN 1 END) AS n_failed FROM raw" for n, p in _EXPECT)
    + """ UNION ALL SELECT cast(sum(c) AS bigint), 'unique:customer_id', cast(coalesce(sum(CASE WHEN c > 1 THEN c END), 0) AS bigint)
      FROM (SELECT count(*) AS c FROM raw GROUP BY customer_id)) SELECT n_rows, expectation, n_failed, n_failed = 0 AS holds FROM x""",
)
def quality_expectations(spark, folder):
    return Q.quality_expectations(customer_raw(spark, folder), "customer_id", TEST_SEGMENTS)


_BEFORE = "max({c}) OVER (PARTITION BY custkey ORDER BY month_no RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"


@query(
    "behaviour_trends",
    f"""WITH m AS (SELECT o_custkey AS custkey, cast(year(o_orderdate) * 12 + month(o_orderdate) AS int) AS month_no,
      cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS cents, count(*) AS n_orders FROM orders GROUP BY 1, 2)
    SELECT custkey, month_no, n_orders, cents / {d('100.0')} AS amount, lag(month_no) OVER (PARTITION BY custkey ORDER BY month_no) AS last_active_month,
    (sum(cents) OVER (PARTITION BY custkey ORDER BY month_no RANGE BETWEEN 2 PRECEDING AND CURRENT ROW))::double / {d('100.0')} / 3 AS moving_amount,
    (cents - {_BEFORE.format(c='cents')}) * {d('100.0')} / {_BEFORE.format(c='cents')} AS var_saldo_pct,
    (n_orders - {_BEFORE.format(c='n_orders')}) * {d('100.0')} / {_BEFORE.format(c='n_orders')} AS var_transacciones_pct FROM m""",
)
def behaviour_trends(spark, folder):
    return P.behaviour_trends(read_table(spark, folder, "orders"))


@query(
    "complaint_channels",
    f"""SELECT CASE {O.COMPLAINT} % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'call_center' WHEN 2 THEN 'email' ELSE 'sucursal' END AS channel,
    count(*) AS n, min(DATE '2000-08-01' - cast({O.COMPLAINT} % 90 + 1 AS int)) AS first_date FROM conversations WHERE role = 'user' GROUP BY 1""",
)
def complaint_channels(spark, folder):
    return complaints(spark, folder).groupBy("channel").agg(F.count("*").alias("n"), F.min("complaint_date").alias("first_date"))


