"""The keyed table, change logs, versioned scores and outcomes of alerts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.quality import customer_order, dedup_latest
from ebbwatch.schemas import CUSTOMER_RAW, EVENTS
from ebbwatch.sources import manifest
from ebbwatch.sources.snapshot import customer_raw
from ebbwatch.streaming import changes as X
from ebbwatch.streaming import flows as W
from ebbwatch.streaming.keyed import KeyedTable, apply_stream, as_of
from ebbwatch.streaming.late import WindowLedger

ITEM = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType()), T.StructField("x", T.StringType())])
CHANGE = "id string, v long, x string, _deleted boolean"


def table(spark, path, **options):
    return KeyedTable(spark, f"file://{path}", ITEM, "id", ["v"], buckets=4, **options)


def content(t):
    return sorted(tuple(r) for r in t.read().collect())


def expected(changes):
    newest = {}
    for c in changes:
        if c[0] is not None:
            newest[c[0]] = max(newest.get(c[0], c), c, key=lambda r: (r[1], r[2] or "", bool(r[3])))
    return sorted(c[:3] for c in newest.values() if not c[3])


def test_any_arrival_gives_the_same_table(spark, tmp_path):
    rng = random.Random(2)
    changes = [(f"k{rng.randint(0, 12)}", rng.randint(0, 20), f"x{i}", rng.random() < 0.2) for i in range(80)]
    changes += [("gone", 5, "a", False), ("gone", 9, "b", True), (None, 1, "n", False), ("undeleted", 1, "a", None)]
    batches = [changes[i::7] for i in range(7)]
    for n, order in enumerate(([*batches], [*reversed(batches)], [*batches, batches[0], batches[3]])):
        t = table(spark, tmp_path / str(n), max_parts=2)
        for b in order:
            t.apply(spark.createDataFrame(b, CHANGE))
        assert content(t) == expected(changes)
        assert max(t.parts_per_bucket().values()) <= 3
    # A change that is older than a deletion does not bring the key back.
    t.apply(spark.createDataFrame([("gone", 7, "late", False)], CHANGE))
    assert content(t) == expected(changes) and not t.lookup("gone").count()


def test_a_replayed_batch_is_skipped_and_old_versions_stay_readable(spark, tmp_path):
    t = table(spark, tmp_path)
    one, two = ([("a", n, f"{n}", False)] for n in (1, 2))
    assert t.version() is None and t.read().count() == 0
    assert t.apply(spark.createDataFrame(one, CHANGE), "w", 0) and t.apply(spark.createDataFrame(two, CHANGE), "w", 1)
    before = t.parts_per_bucket()
    assert not t.apply(spark.createDataFrame([("b", 1, "", False)], CHANGE), "w", 1)
    assert t.parts_per_bucket() == before and t.apply(spark.createDataFrame([("b", 1, "", False)], CHANGE), "other", 0)
    assert [r.x for r in t.read(0).collect()] == ["1"] and content(t) == [("a", 2, "2"), ("b", 1, "")]
    t.compact(1)
    assert set(t.parts_per_bucket().values()) == {1} and content(t) == [("a", 2, "2"), ("b", 1, "")]
    assert t.vacuum(1) > 0 and content(t) == [("a", 2, "2"), ("b", 1, "")]


def test_reading_costs_a_bounded_number_of_parts(spark, tmp_path):
    t = table(spark, tmp_path, max_parts=3)
    for b in range(12):
        t.apply(spark.createDataFrame([(f"k{i}", b, "x", False) for i in range(8)], CHANGE), "w", b)
    assert max(t.parts_per_bucket().values()) <= 3 and {r.v for r in t.read().collect()} == {11}


def test_of_two_writers_one_tries_again(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.apply(spark.createDataFrame([("a", 1, "1", False)], CHANGE))
    late, publish = [spark.createDataFrame([("b", 1, "1", False)], CHANGE)], manifest.publish

    def slow(*arguments):
        if late:
            t.apply(late.pop())
        return publish(*arguments)

    monkeypatch.setattr(manifest, "publish", slow)
    t.apply(spark.createDataFrame([("c", 1, "1", False)], CHANGE))
    assert [r[0] for r in content(t)] == ["a", "b", "c"]
    with pytest.raises(manifest.VersionTaken):
        publish(spark, f"{t.path}/manifest", 0, {})


def test_a_lookup_reads_the_buckets_of_its_keys(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(spark.createDataFrame([(f"k{i}", 1, str(i), False) for i in range(50)], CHANGE))
    found = t.lookup("k7")
    assert [r.x for r in found.collect()] == ["7"] and t.lookup("nobody").count() == 0
    files = {f.split("/")[-2] for f in found.inputFiles()}
    assert len(files) == 1 and len({f.split("/")[-2] for f in t.read().inputFiles()}) == 4
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,k7)]" in found._jdf.queryExecution().executedPlan().toString()


def test_history_keeps_versions(spark, tmp_path):
    all_, two = (table(spark, tmp_path / str(h), history=h, max_parts=1) for h in (None, 2))
    for v in (3, 1, 2, 2):
        for t in (all_, two):
            t.apply(spark.createDataFrame([("a", v, str(v), False)], CHANGE))
    assert [r[1] for r in content(all_)] == [1, 2, 3] and [r[1] for r in content(two)] == [2, 3]


# ----------------------------------------------------------------------------------- customers, scores


def test_change_log_equals_deduplication(spark, tmp_path, folder):
    raw = customer_raw(spark, folder)
    path = f"{tmp_path}/log"
    for _ in range(2):
        raw.withColumn("op", F.lit("update")).repartition(3, F.rand(7)).write.mode("append").parquet(path)
    t = X.customer_table(spark, f"file://{tmp_path}/customers", buckets=4, max_parts=2)
    apply_stream(W.stream_table(spark, path, X.CUSTOMER_CHANGE, files_per_trigger=2), t, "log", X.customer_changes)
    want = dedup_latest(raw.where("customer_id is not null"), "customer_id", "ingestion_ts", customer_order(raw.columns))
    assert t.read().exceptAll(want.select(*CUSTOMER_RAW.names)).count() == 0 and t.read().count() == want.count()


def test_a_batch_is_kept_while_it_is_applied(spark, tmp_path):
    path = f"{tmp_path}/keys"
    spark.range(20).selectExpr("id as k", "id as t").write.parquet(path)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.LongType())])
    t = KeyedTable(spark, f"file://{tmp_path}/table", schema, "k", ["t"], buckets=2)
    batches = []
    apply_stream(W.stream_table(spark, path, schema), t, "keys", lambda batch: batches.append((batch, batch.is_cached)) or batch)
    assert [kept for _, kept in batches] == [True] and not batches[0][0].is_cached
    assert t.read().count() == 20


def test_a_score_published_between_batches_is_used(spark, tmp_path):
    board = X.score_board(spark, f"file://{tmp_path}/board", buckets=2)
    scores = spark.createDataFrame([("c", 0.5, "MEDIO", "a")], "customer_id string, churn_probability double, churn_risk_level string, recommended_action string")
    utc = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc)
    batch = spark.createDataFrame([(1, "c", utc(1)), (2, "c", utc(5)), (3, "d", utc(5)), (4, "c", utc(0)), (5, None, utc(1))], "event_id long, customer_id string, ts timestamp")
    X.publish_scores(board, scores, "2024-01-01 01:00:00+00")
    rated = lambda: {r.event_id: r.churn_probability for r in X.score_events_as_of(batch, board).collect()}
    assert rated() == {1: 0.5, 2: 0.5, 3: None, 4: None, 5: None}
    X.publish_scores(board, scores.withColumn("churn_probability", F.lit(0.9)), "2024-01-01 04:00:00+00")
    assert rated() == {1: 0.5, 2: 0.9, 3: None, 4: None, 5: None}
    alerts = X.alert_table(spark, f"file://{tmp_path}/alerts", buckets=2)
    rows = batch.withColumn("event_type", F.lit("click"))
    alerts.apply(X.alerts_of(rows, board))
    assert sorted(r.event_id for r in alerts.read().collect()) == [1, 2]
    X.publish_scores(board, scores.withColumn("churn_risk_level", F.lit("BAJO")), "2024-01-01 04:30:00+00")
    alerts.apply(X.alerts_of(rows, board))
    assert sorted(r.event_id for r in alerts.read().collect()) == [1]


def test_as_of_takes_the_latest_version_not_later(spark):
    rows = spark.createDataFrame([(i, "a", i) for i in range(10)] + [(10, "b", 3), (11, None, 3)], "n long, k string, t long")
    versions = spark.createDataFrame([("a", 2, "two"), ("a", 5, "five"), ("b", 9, "nine")], "k string, s long, x string")
    found = {r.n: r.x for r in as_of(rows, versions, "k", "t", "s").collect()}
    assert found == {**{i: None if i < 2 else "two" if i < 5 else "five" for i in range(10)}, 10: None, 11: None}


# -------------------------------------------------------------------------------------------- outcomes


def test_outcomes_of_alerts_and_their_state(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    event = lambda i, hours, user, kind: (i, start + dt.timedelta(hours=hours), user, kind, 1.0, "{}")
    first = [event(1, 0, 1, "error"), event(2, 1, 2, "error"), event(3, 2, 1, "purchase"), event(4, 3, 1, "purchase"), event(5, 1, None, "error")]
    second = [event(6, 26, 2, "purchase"), event(7, 100, 3, "error"), event(8, 100, 3, "purchase")]
    third = [event(9, 200, 4, "error"), event(10, 200, 4, "purchase")]
    for n, rows in enumerate((first, second, third)):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    stream = W.alert_outcomes(W.event_stream(spark, str(tmp_path), files_per_trigger=1), "error", "purchase", "24 hours")
    query = (
        stream.writeStream.format("memory").queryName("outcomes").outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = {r.event_id: r for r in spark.table("outcomes").collect()}
    assert set(rows) == {1, 2, 7}  # the alert at hour 200 is still open
    assert (rows[1].n_answers, rows[1].answered_at.hour, rows[1].answered) == (2, 2, True)
    assert not rows[2].answered and rows[2].answered_at is None  # answered after 25 hours
    assert not rows[7].answered  # not by what comes at the same moment
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] < max(held)


def test_late_rows_are_kept_aside_and_their_windows_corrected(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    event = lambda i, minutes, kind="a": (i, start + dt.timedelta(minutes=minutes), 1, kind, 1.0, "{}")
    batches = [
        [event(1, 5), event(2, 10), event(3, 70), event(4, 200)],  # the clock is at 140 minutes: two windows are out
        [event(5, 20), event(6, 130), event(7, 210), event(8, 30, "b"), (9, None, 1, "a", 1.0, "{}")],  # 5 and 8 are late
        [event(10, 25), event(11, 400)],
    ]
    frames = [spark.createDataFrame(b, EVENTS).withColumn("ts", W.utc_instant("ts")) for b in batches]
    ledger = WindowLedger(spark, f"file://{tmp_path}", frames[0].schema, "event_id", "event_type", buckets=2)
    for n, frame in enumerate(frames):
        ledger.apply(frame, n)
    log = sorted((r.who, r.start.hour, r.batch_id, r.change, r.n) for r in ledger.log.read().withColumn("start", W.utc_clock("start")).collect())
    assert log == [
        ("a", 0, 0, "add", 2), ("a", 0, 1, "add", 3), ("a", 0, 1, "retract", 2), ("a", 0, 2, "add", 4), ("a", 0, 2, "retract", 3),
        ("a", 1, 0, "add", 1), ("a", 2, 2, "add", 1), ("a", 3, 2, "add", 2), ("b", 0, 1, "add", 1),
    ]
    assert sorted(r.event_id for r in ledger.late.read().collect()) == [5, 8, 10]
    rows = [e for b in batches for e in b if e[1] is not None]
    want = {}
    for e in rows:
        if e[1].replace(minute=0) + dt.timedelta(hours=1) <= start + dt.timedelta(minutes=340):
            want[e[3], e[1].hour] = want.get((e[3], e[1].hour), 0) + 1
    told = lambda: {(r.who, r.start.hour): r.n for r in ledger.published().withColumn("start", W.utc_clock("start")).collect()}
    assert told() == want
    ledger.apply(frames[2], 2)
    assert told() == want and ledger.counts.read().agg(F.sum("n")).first()[0] == len(rows)
