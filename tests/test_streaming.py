from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberline.operators import daily as A
from emberline.session import new_folder
from emberline.streaming import detections as V
from emberline.streaming import requests as Q
from emberline.streaming import runs as J

SCHEMA = "latitude double, longitude double, acq_datetime_utc timestamp, satellite string, province_id string"


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


@pytest.mark.parametrize("salts", [1, 4])
def test_restart_adds_only_what_is_new(spark, salts):
    base = new_folder(spark, "stream")
    t = dt.datetime(2024, 1, 1, 12)
    first = [(float(i), 1.0, t, "N", "a") for i in range(20)] + [(0.0, 1.0, t, "N", "b")] * 30
    rows(spark, first).repartition(5).write.mode("append").parquet(f"{base}/in")

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        J.append_available(V.dedup(stream, salts=salts), f"{base}/out", f"{base}/cp")
        return spark.read.schema(SCHEMA).parquet(f"{base}/out")
    assert run().count() == 20
    assert run().count() == 20
    rows(spark, [(0.0, 1.0, t, "N", "c"), (99.0, 1.0, t, "N", "a")]).write.mode("append").parquet(f"{base}/in")
    got = run()
    assert got.count() == 21 and got.filter("latitude = 0").count() == 1


def test_daily_counts_equal_batch_once_the_watermark_has_passed(spark):
    base = new_folder(spark, "daily")
    items = [(1.0, 1.0, dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i), "N", "ab"[i % 2]) for i in range(40)]
    rows(spark, items).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    J.append_available(V.daily_counts(stream), f"{base}/out", f"{base}/cp")
    got = {(r["date"], r["province_id"]): r["hotspot_count"] for r in spark.read.parquet(f"{base}/out").collect()}
    batch = A.count_daily(rows(spark, items), "acq_datetime_utc").collect()
    last = max(r["acq_date"] for r in batch)
    assert got == {(r["acq_date"], r["province_id"]): r["hotspot_count"] for r in batch if r["acq_date"] < last}


def test_alert_files_become_triggers(spark):
    base = new_folder(spark, "alerts")
    payload = '{"alerts":[{"status":"firing","labels":{"alertname":"x"}}]}'
    spark.createDataFrame([(dt.datetime(2024, 1, 1), payload)], "ts timestamp, payload string").write.json(f"{base}/in")
    J.append_available(J.triggers(spark, f"{base}/in"), f"{base}/out", f"{base}/cp")
    assert [(r["alert"], r["reason"]) for r in spark.read.parquet(f"{base}/out").collect()] == [("x", "grafana_alert:x")]


def test_the_first_in_order_stays_whatever_arrives_first(spark):
    base = new_folder(spark, "first")
    t = dt.datetime(2024, 1, 1, 12)
    copies = [(1.0, 1.0, t, "N", name) for name in ["b"] * 40 + ["a", "c"]]
    rest = [(2.0, 1.0, t, None, "z"), (2.0, 1.0, t, None, None), (3.0, 1.0, None, "N", "a"), (9.0, 1.0, t + dt.timedelta(hours=9), "N", "a")]

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        J.append_available(V.dedup_first(stream, [F.col("province_id")]), f"{base}/out", f"{base}/cp")
        return sorted((r["latitude"], r["province_id"] or "") for r in spark.read.schema(SCHEMA).parquet(f"{base}/out").collect())
    rows(spark, copies + rest).repartition(6).write.parquet(f"{base}/in")
    assert run() == [(1.0, "a"), (2.0, "")]
    rows(spark, [(1.0, 1.0, t, "N", "0"), (9.0, 1.0, t + dt.timedelta(hours=9), "N", "0"), (8.0, 1.0, t + dt.timedelta(days=1), "N", "q")]).write.mode(
        "append").parquet(f"{base}/in")
    # The first row is later than the watermark and goes; the second one still counts.
    assert run() == [(1.0, "a"), (2.0, ""), (9.0, "0")]


def test_runs_end_at_gaps_and_count_late_rows(spark):
    base, start = new_folder(spark, "runs"), dt.datetime(2024, 1, 1, 12)

    def land(minutes, seconds=5.0):
        items = [(start + dt.timedelta(minutes=m, seconds=10), seconds) for m in minutes]
        spark.createDataFrame(items, "ts timestamp, duration_s double").write.mode("append").parquet(f"{base}/in")

    def run():
        log = spark.readStream.schema("ts timestamp, duration_s double").parquet(f"{base}/in")
        J.append_available(Q.latency_runs(log), f"{base}/out", f"{base}/cp")
        found = spark.read.parquet(f"{base}/out").orderBy("held_from").collect()
        return [((r["held_from"] - start).seconds // 60, (r["firing_from"] - start).seconds // 60, (r["held_to"] - start).seconds // 60,
                 r["n_evaluations"]) for r in found]
    # A slow request at minute m holds at the evaluations m + 1 to m + 5: runs of 7, 5 (too short) and 6 evaluations.
    land([0, 2, 30, 60])
    land([30, 60], 0.001)
    assert run() == [(1, 6, 7, 7)]
    land([61])      # behind the newest row, within the delay
    land([200], 0.001)
    assert run() == [(1, 6, 7, 7), (61, 66, 66, 6)]
    land([1], 9.0)      # later than the delay: no second run
    land([400], 0.001)
    assert run() == [(1, 6, 7, 7), (61, 66, 66, 6)]


def test_a_replayed_batch_adds_nothing(spark):
    path, t = new_folder(spark, "once"), dt.datetime(2024, 1, 1)
    assert J.written_batches(spark, path).count() == 0
    write = J.batch_writer(path, "a")
    batch = rows(spark, [(float(i), 1.0, t, "N", "a") for i in range(5)])
    # A writer that stopped before its batch was listed leaves files that don't count; the replay replaces them.
    batch.union(batch).write.parquet(f"{path}/stream=a/batch=0")
    assert J.read_batches(spark, path, SCHEMA).count() == 0
    for number in (0, 0, 1, 0, 1):
        write(batch, number)
    J.batch_writer(path, "b")(batch.limit(1), 0)
    got = J.read_batches(spark, path, SCHEMA)
    assert {(r["stream"], r["batch"]): r["count"] for r in got.groupBy("stream", "batch").count().collect()} == {("a", 0): 5, ("a", 1): 5, ("b", 0): 1}


def test_restart_of_a_stream_that_adds_batches(spark):
    base, t = new_folder(spark, "restart"), dt.datetime(2024, 1, 1)

    def run():
        J.add_available(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), f"{base}/out", f"{base}/cp", "s")
        return J.read_batches(spark, f"{base}/out", SCHEMA).count()
    rows(spark, [(1.0, 1.0, t, "N", "a")] * 3).write.parquet(f"{base}/in")
    assert run() == 3 and run() == 3
    rows(spark, [(2.0, 1.0, t, "N", "a")]).write.mode("append").parquet(f"{base}/in")
    assert run() == 4
