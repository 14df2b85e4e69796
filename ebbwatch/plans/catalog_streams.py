"""Streaming queries, run over the event table until its input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.functions.scalar import round_half_up
from ebbwatch.operators.quality import raw_to_silver
from ebbwatch.operators.scoring import add_risk_bands
from ebbwatch.plans import oracle as O
from ebbwatch.plans.registry import query, scored
from ebbwatch.sources.snapshot import customer_key, customer_raw
from ebbwatch.sources.storage import read_table, scratch_path
from ebbwatch.streaming import changes as X
from ebbwatch.streaming import flows as W
from ebbwatch.streaming.keyed import apply_stream
from ebbwatch.streaming.late import WindowLedger

_KEY = "'CLI-' || lpad(cast(user_id AS varchar), 7, '0')"
ALWAYS = "1970-01-01 00:00:00+00"


def _board(spark, folder):
    """Scores published once, valid for all events."""
    board = X.score_board(spark, scratch_path(spark, "score-board"))
    X.publish_scores(board, scored(spark, folder), ALWAYS)
    return board


def _half_files(spark, folder, at):
    """The events before and from a time on, as two files that a stream takes one after the other."""
    events = read_table(spark, folder, "events")
    path = scratch_path(spark, "events-in-halves")
    events.where(F.col("ts") < at).coalesce(1).write.parquet(f"{path}/events.parquet")
    events.where(F.col("ts") >= at).coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    return path


@query(
    "stream_silver",
    f"""SELECT event_id, ts, {_KEY} AS customer_id, event_type, value,
    try_cast(json_extract_string(props, '$.k') AS int) AS k FROM events WHERE user_id IS NOT NULL""",
)
def stream_silver(spark, folder):
    """Every event is delivered twice; the silver stream keeps it once."""
    events = W.event_stream(spark, folder)
    table = W.run_to_table(W.silver_events(events.unionByName(events)), "silver-events")
    return table.withColumn("ts", W.utc_clock("ts"))


@query(
    "stream_scores",
    f"""WITH {O.SCORED} SELECT event_id, customer_id, event_type, churn_probability, churn_risk_level, recommended_action
    FROM (SELECT event_id, event_type, {_KEY} AS customer_id FROM events) LEFT JOIN scored USING (customer_id)""",
)
def stream_scores(spark, folder):
    events = W.silver_events(W.event_stream(spark, folder)).select("event_id", "customer_id", "event_type", "ts")
    board = _board(spark, folder)
    schema = T.StructType([*events.schema.fields[:3], *X.SCORES.fields[2:]])
    return W.run_batches(events, "scored-events", schema, lambda batch: X.score_events_as_of(batch, board).drop("ts")).drop("batch_id")


_HALF = "TIMESTAMP '2024-01-15 00:00:00'"
_SECOND_SCORE = O.half_up(f"CASE WHEN errors >= 10 THEN least(churn_probability + {O.d('0.1')}, {O.d('1.0')}) ELSE churn_probability END", 4)


@query(
    "stream_scores_as_of",
    f"""WITH {O.SCORED},
    e AS (SELECT *, {_KEY} AS customer_id FROM events),
    errors AS (SELECT customer_id, count(*) AS errors FROM e WHERE event_type = 'error' AND ts < {_HALF} GROUP BY 1),
    second AS (SELECT customer_id, {_SECOND_SCORE} AS p FROM scored LEFT JOIN errors USING (customer_id)),
    rated AS (SELECT event_id, customer_id, CASE WHEN ts < {_HALF} THEN churn_probability ELSE p END AS churn_probability
      FROM e LEFT JOIN scored USING (customer_id) LEFT JOIN second USING (customer_id))
    SELECT event_id, customer_id, churn_probability,
      CASE WHEN churn_probability IS NULL THEN NULL ELSE {O.risk_level('churn_probability')} END AS churn_risk_level FROM rated""",
)
def stream_scores_as_of(spark, folder):
    """A second version of the scores, raised by the errors of half a month, is published while the stream runs: after
    its first batch, valid from then on."""
    half = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    path = _half_files(spark, folder, half)
    events = W.silver_events(W.event_stream(spark, path, files_per_trigger=1)).select("event_id", "customer_id", "ts")
    board = _board(spark, folder)
    seen = read_table(spark, folder, "events").where((F.col("event_type") == "error") & (F.col("ts") < half))
    errors = seen.groupBy(customer_key("user_id").alias("customer_id")).agg(F.count("*").alias("errors"))
    raised = F.when(F.col("errors") >= 10, F.least(F.col("churn_probability") + 0.1, F.lit(1.0))).otherwise(F.col("churn_probability"))

    def score(batch):
        if board.version() == 0 and batch.where(W.utc_clock("ts") >= half).count():
            first = board.read().drop("valid_from")  # the scores are not computed anew
            second = first.join(errors, "customer_id", "left").withColumn("churn_probability", round_half_up(raised, 4))
            X.publish_scores(board, add_risk_bands(second), "2024-01-15 00:00:00+00")
        return X.score_events_as_of(batch, board).select("event_id", "customer_id", "churn_probability", "churn_risk_level")

    schema = T.StructType([*events.schema.fields[:2], *X.SCORES.fields[2:4]])
    return W.run_batches(events, "scored-as-of", schema, score).drop("batch_id")


@query(
    "stream_customer_changes",
    f"""WITH {O.FACTS}, log AS (
      SELECT {O.RAW_COLUMNS}, false AS gone FROM raw
      UNION ALL SELECT {O.RAW_COLUMNS.replace("ingestion_ts", "ingestion_ts + INTERVAL 1 DAY")}, true FROM raw WHERE ingestion_ts = {O.C} AND age % 10 = 3
      UNION ALL SELECT {O.RAW_COLUMNS.replace("ingestion_ts", "ingestion_ts + INTERVAL 2 DAY")}, false FROM raw WHERE ingestion_ts = {O.C} AND age % 10 = 3 AND region = 'ASIA'),
    newest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ingestion_ts DESC, age DESC) = 1)
    SELECT customer_id, age, region, avg_balance_6m, coalesce(app_logins_30d, 0) AS app_logins_30d,
      coalesce(nps_score, 5) AS nps_score, churn_label, ingestion_ts
    FROM newest WHERE NOT gone AND churn_label IS NOT NULL""",
)
def stream_customer_changes(spark, folder):
    """A log of inserts, updates and deletions, in files that hold its changes out of order and each twice, is applied
    to the customer table batch by batch; the silver rows of what is left."""
    raw = customer_raw(spark, folder)
    last = raw.where((F.col("ingestion_ts") == F.lit("2000-08-01 00:00:00").cast("timestamp_ntz")) & (F.col("age") % 10 == 3))
    later = lambda days: F.col("ingestion_ts") + F.expr(f"INTERVAL {days} DAY")
    log = (
        raw.withColumn("op", F.lit("update"))
        .union(last.withColumn("ingestion_ts", later(1)).withColumn("op", F.lit("delete")))
        .union(last.where("region = 'ASIA'").withColumn("ingestion_ts", later(2)).withColumn("op", F.lit("insert")))
    )
    path = scratch_path(spark, "customer-changes")
    dealt = log.repartition(4, F.xxhash64("customer_id", "ingestion_ts"))
    for _ in range(2):
        dealt.write.mode("append").parquet(path)
    table = X.customer_table(spark, scratch_path(spark, "customers"), max_parts=3)
    feed = W.stream_table(spark, path, X.CUSTOMER_CHANGE, files_per_trigger=2)
    apply_stream(feed, table, "customer-changes", X.customer_changes)
    names = ("customer_id", "age", "region", "avg_balance_6m", "app_logins_30d", "nps_score", "churn_label", "ingestion_ts")
    return raw_to_silver(table.read()).select(*names)


@query(
    "stream_activity_windows",
    """WITH b AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed FROM events),
    h AS (SELECT event_type, date_trunc('hour', ts) AS h FROM events),
    s0 AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
    s1 AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM s0),
    w AS (SELECT 'tumbling' AS kind, event_type AS who, h AS start, h + INTERVAL 1 HOUR AS "end", count(*) AS n FROM h GROUP BY ALL
      UNION ALL SELECT 'sliding', event_type, h, h + INTERVAL 2 HOUR, count(*) FROM (SELECT event_type, h FROM h UNION ALL SELECT event_type, h - INTERVAL 1 HOUR FROM h) GROUP BY ALL
      UNION ALL SELECT 'session', cast(user_id AS varchar), min(ts), max(ts) + INTERVAL 30 MINUTE, count(*) FROM s1 GROUP BY user_id, s)
    SELECT kind, who, start, "end", n FROM w, b WHERE "end" <= closed""",
)
def stream_activity_windows(spark, folder):
    """Windows that the watermark has closed; the last hour stays open in a stream."""
    result = None
    for kind in ("tumbling", "sliding", "session"):
        table = W.run_to_table(W.activity_windows(W.event_stream(spark, folder), kind), f"windows-{kind}")
        result = table if result is None else result.unionByName(table)
    closed = read_table(spark, folder, "events").agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).scalar()
    clocked = result.withColumns({"start": W.utc_clock("start"), "end": W.utc_clock("end")})
    return clocked.where(F.col("end") <= closed)


@query(
    "stream_customer_state",
    """SELECT user_id, count(*) AS n_events, count(CASE WHEN event_type = 'error' THEN 1 END) AS n_errors,
    count(CASE WHEN event_type = 'purchase' THEN 1 END) AS n_purchases, cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS cents,
    epoch_us(max(ts)) AS last_micros FROM events GROUP BY 1""",
)
def stream_customer_state(spark, folder):
    """The last reported state of each customer."""
    states = W.customer_state(W.event_stream(spark, folder))
    return W.newest_versions(W.run_batches(states, "customer-state", W.STATE_SCHEMA, mode="update"), "user_id")


@query(
    "stream_sink_upsert",
    f"""WITH {O.SCORED} SELECT event_id, customer_id, event_type, churn_risk_level, strftime(day, '%Y-%m-%d') AS day
    FROM (SELECT event_id, event_type, cast(ts AS date) AS day, {_KEY} AS customer_id FROM events) JOIN scored USING (customer_id)
    WHERE churn_risk_level IN ('ALTO', 'MEDIO')""",
)
def stream_sink_upsert(spark, folder):
    """Alerts for events of customers at risk, upserted by event into a compacted table."""
    events = W.silver_events(W.event_stream(spark, folder)).select("event_id", "customer_id", "event_type", "ts")
    board = _board(spark, folder)
    table = X.alert_table(spark, scratch_path(spark, "alerts"))
    apply_stream(events, table, "alerts", lambda batch: X.alerts_of(batch, board))
    return table.read().drop("valid_from")


@query(
    "profile_lookup",
    f"""WITH {O.SCORED} SELECT customer_id, segment, n_products, churn_probability, churn_risk_level, vip_classification
    FROM scored WHERE customer_id IN ('CLI-0000001', 'CLI-0000042', 'CLI-0000100')""",
)
def profile_lookup(spark, folder):
    """Profiles of a few customers from a table kept by key: their buckets are read, nothing is scored anew."""
    names = ["customer_id", "segment", "n_products", "churn_probability", "churn_risk_level", "vip_classification"]
    table = X.profile_table(spark, scratch_path(spark, "profiles"))
    table.apply(scored(spark, folder).select(*names, F.col("ingestion_ts").alias("as_of")))
    return table.lookup("CLI-0000001", "CLI-0000042", "CLI-0000100").drop("as_of")


@query(
    "stream_alert_outcomes",
    f"""WITH e AS (SELECT event_id, {_KEY} AS customer_id, ts, event_type FROM events WHERE user_id IS NOT NULL),
    a AS (SELECT event_id, customer_id, ts AS alerted_at FROM e WHERE event_type = 'error'),
    p AS (SELECT customer_id AS answered_by, ts AS t FROM e WHERE event_type = 'purchase'),
    ends AS (SELECT least(max(CASE WHEN event_type = 'error' THEN ts END), max(CASE WHEN event_type = 'purchase' THEN ts END)) - INTERVAL 25 HOUR AS closed FROM events)
    SELECT event_id, customer_id, alerted_at, min(t) AS answered_at, count(t) AS n_answers, count(t) > 0 AS answered
    FROM a CROSS JOIN ends LEFT JOIN p ON customer_id = answered_by AND t > alerted_at AND t <= alerted_at + INTERVAL 24 HOUR
    WHERE alerted_at < closed GROUP BY ALL""",
)
def stream_alert_outcomes(spark, folder):
    """For every alert (an error) whether the customer bought something within a day; alerts that are still open when
    the stream ends are not told yet."""
    events = W.event_stream(spark, folder)
    outcomes = W.run_to_table(W.alert_outcomes(events, "error", "purchase", "24 hours"), "alert-outcomes")
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts")))
    ends = read_table(spark, folder, "events").agg(F.least(last("error"), last("purchase")) - F.expr("INTERVAL 25 HOUR"))
    clocked = outcomes.withColumns({"alerted_at": W.utc_clock("alerted_at"), "answered_at": W.utc_clock("answered_at")})
    return clocked.where(F.col("alerted_at") < ends.scalar())


@query(
    "stream_window_corrections",
    """WITH e AS (SELECT event_id, event_type AS who, ts, date_trunc('hour', ts) AS start FROM events WHERE event_type IS NOT NULL),
    c AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed, max(CASE WHEN event_id % 50 <> 0 THEN ts END) - INTERVAL 1 HOUR AS before FROM e)
    SELECT who, start, count(*) AS n, count(CASE WHEN event_id % 50 = 0 AND start + INTERVAL 1 HOUR <= before THEN 1 END) AS n_late
    FROM e CROSS JOIN c WHERE start + INTERVAL 1 HOUR <= closed GROUP BY ALL""",
)
def stream_window_corrections(spark, folder):
    """Hourly counts when one event in fifty comes after all others: published, corrected, and how many came late."""
    events = read_table(spark, folder, "events")
    path = scratch_path(spark, "events-with-late-ones")
    for part in (F.col("event_id") % 50 != 0, F.col("event_id") % 50 == 0):
        events.where(part).coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    stream = W.event_stream(spark, path, files_per_trigger=1)
    ledger = WindowLedger(spark, scratch_path(spark, "window-ledger"), stream.schema, "event_id", "event_type", buckets=4)
    ledger.run(stream, "window-ledger")
    windowed = ledger.late.read().groupBy(F.col("event_type").alias("who"), F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n_late"))
    late = windowed.select("who", F.col("w.start").alias("start"), "n_late")
    told = ledger.published().join(late, ["who", "start"], "left")
    return told.select("who", W.utc_clock("start").alias("start"), "n", F.coalesce("n_late", F.lit(0)).alias("n_late"))
