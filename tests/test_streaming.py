"""Streams over small files: state across batches, late rows, redelivery and replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbwatch.schemas import ALERTS, EVENTS
from ebbwatch.sources import storage
from ebbwatch.streaming import flows as W

START = dt.datetime(2024, 1, 1)


def event(i, minutes, user=1, kind="click", value=1.5):
    return (i, START + dt.timedelta(minutes=minutes), user, kind, value, '{"k": %d}' % i)


def write(spark, path, *files):
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{path}/part{n}")
    import glob
    import os
    import time

    names = []
    for n in range(len(files)):
        source = glob.glob(f"{path}/part{n}/*.parquet")[0]
        target = f"{path}/in/events.parquet/part-{n}.parquet"
        os.makedirs(f"{path}/in/events.parquet", exist_ok=True)
        with open(source, "rb") as a, open(target, "wb") as b:
            b.write(a.read())
        os.utime(target, (time.time() + n, time.time() + n))
        names.append(target)
    return f"{path}/in"


def test_silver_keeps_each_event_once_and_drops_late_rows(spark, tmp_path):
    folder = write(
        spark, str(tmp_path), [event(1, 0), event(2, 600)], [event(2, 600), event(3, 610)], [event(4, 5), event(5, 620)]
    )
    stream = W.silver_events(W.event_stream(spark, folder, files_per_trigger=1))
    got = sorted(r.event_id for r in W.run_to_table(stream, "t").collect())
    assert got == [1, 2, 3, 5]  # 4 is older than the watermark


def test_state_adds_up_over_batches(spark, tmp_path):
    folder = write(
        spark, str(tmp_path), [event(1, 0, 7, "error"), event(2, 1, 7), event(3, 1, 8)], [event(4, 9, 7, "purchase", 2.25)]
    )
    states = W.customer_state(W.event_stream(spark, folder, files_per_trigger=1))
    rows = W.run_batches(states, "s", W.STATE_SCHEMA, mode="update").collect()
    last = {r.user_id: r for r in sorted(rows, key=lambda r: r.n_events)}
    assert len(rows) == 3
    assert (last[7].n_events, last[7].n_errors, last[7].n_purchases, last[7].cents) == (3, 1, 1, 525)
    assert last[8].n_events == 1


def test_state_takes_nulls(spark, tmp_path):
    folder = write(spark, str(tmp_path), [event(1, 0, 7, value=None), event(2, 1, 7), event(3, 1, None), event(4, 2, 7, value=float("nan"))])
    rows = W.run_batches(W.customer_state(W.event_stream(spark, folder)), "s", W.STATE_SCHEMA, mode="update").collect()
    assert {r.user_id: (r.n_events, r.cents) for r in rows} == {7: (3, 150), None: (1, 150)}


def test_one_file_and_a_directory_give_the_same_rows(spark, tmp_path, folder):
    spark.read.parquet(f"{folder}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/many/events.parquet")
    one, many = (
        W.run_to_table(W.silver_events(W.event_stream(spark, f)), "t").select("event_id").toPandas().event_id
        for f in (folder, f"{tmp_path}/many")
    )
    assert len(one) == 1000 and sorted(one) == sorted(many)


def test_session_windows(spark, tmp_path):
    folder = write(spark, str(tmp_path), [event(1, 0), event(2, 29), event(3, 60), event(4, 400, 2)])
    rows = W.run_to_table(W.activity_windows(W.event_stream(spark, folder), "session"), "w").collect()
    assert sorted((r.who, r.n) for r in rows) == [("1", 1), ("1", 2)]
    with pytest.raises(ValueError):
        W.activity_windows(W.event_stream(spark, folder), "hopping")


def test_scores_join_keeps_unknown_customers(spark, tmp_path):
    folder = write(spark, str(tmp_path), [event(i, i, user=1 if i % 3 else 2) for i in range(30)])
    scores = spark.createDataFrame([("CLI-0000001", 0.8)], "customer_id string, churn_probability double")
    events = W.silver_events(W.event_stream(spark, folder)).select("event_id", "customer_id")
    schema = W.T.StructType([*events.schema.fields, scores.schema["churn_probability"]])
    rows = W.run_batches(events, "j", schema, lambda b: W.score_events(b, scores)).collect()
    assert len(rows) == 30
    assert all((r.churn_probability == 0.8) == (r.customer_id == "CLI-0000001") for r in rows)


def test_replayed_batches_do_not_duplicate(spark, tmp_path):
    path = str(tmp_path / "sink")
    write_batch = W.batch_writer(path, lambda b: b, ["day"])
    first = spark.createDataFrame([(1, "a", "click", "ALTO", "2024-01-01"), (2, "b", "click", "ALTO", "2024-01-01")], ALERTS)
    second = spark.createDataFrame([(2, "b", "click", "MEDIO", "2024-01-02")], ALERTS)
    for batch, number in ((first, 0), (second, 1), (first, 0)):
        write_batch(batch, number)
    stored = spark.read.option("basePath", path).parquet(path)
    assert stored.count() == 3
    newest = {r.event_id: r.churn_risk_level for r in W.newest_versions(stored, "event_id").collect()}
    assert newest == {1: "ALTO", 2: "MEDIO"}


def test_a_batch_without_rows_is_not_transformed(spark, tmp_path):
    path, asked = str(tmp_path / "sink"), spark.sparkContext.accumulator(0)

    @F.udf("long")
    def doubled(x):
        asked.add(1)
        return 2 * x

    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        runs.add(1)
        return rows

    rows = spark.range(6).repartition(2)
    write_batch = W.batch_writer(path, lambda b: b.join(b.groupBy().agg(F.count("*").alias("n"))).select(doubled("id").alias("id"), "n"))
    write_batch(rows.mapInArrow(counted, "id long"), 0)
    assert runs.value == 2 and asked.value == 6
    write_batch(rows.where("id < 0").mapInArrow(counted, "id long"), 1)
    assert runs.value == 4  # each task once: the steps of an empty batch are not run again for each use
    stored = spark.read.option("basePath", path).parquet(path)
    assert sorted((r.id, r.n, r.batch_id) for r in stored.collect()) == [(2 * i, 6, 0) for i in range(6)]
    rows = W.run_batches(spark.readStream.schema(EVENTS).parquet(write(spark, str(tmp_path / "in"), []) + "/event[s].parquet"), "none", EVENTS)
    assert rows.columns == [*EVENTS.names, "batch_id"]


def test_optional_table_and_scratch(spark, tmp_path):
    assert storage.read_optional(spark, str(tmp_path / "none.parquet"), ALERTS).count() == 0
    storage.write_table(spark.range(10), str(tmp_path / "some.parquet"), files=3)
    assert len(list((tmp_path / "some.parquet").glob("*.parquet"))) == 3
    assert storage.read_typed(spark, str(tmp_path / "some.parquet"), spark.range(1).schema).count() == 10
    assert storage.project_available(spark.range(1).withColumn("b", F.lit(1)), ["b", "x", "id"]).columns == ["b", "id"]
    df = storage.materialize(spark.range(5), "m")
    assert df.count() == 5 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_event_time_does_not_depend_on_the_session_zone(spark, tmp_path):
    folder = write(spark, str(tmp_path), [event(1, 0)])
    with W.session_setting(spark, "spark.sql.session.timeZone", "America/New_York"):
        rows = spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet").withColumn("at", W.utc_instant("ts"))
        row = rows.select(F.unix_micros("at").alias("u"), W.utc_clock("at").alias("clock")).collect()[0]
    assert row.u == 1704067200000000 and row.clock == START


def test_second_scores_come_from_the_published_ones(spark, folder, monkeypatch):
    from ebbwatch.plans import catalog_streams

    asked, scored = [], catalog_streams.scored
    monkeypatch.setattr(catalog_streams, "scored", lambda *a: asked.append(1) or scored(*a))
    catalog_streams.stream_scores_as_of(spark, folder)
    assert len(asked) == 1
