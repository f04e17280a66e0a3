from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.histogram import bucket_counts, bucket_quantile
from emberline.functions.risk import status_class
from emberline.operators import alerts as L
from emberline.operators import drift as G
from emberline.operators import ranks as K
from emberline.operators import requests as R

T0 = dt.datetime(2024, 1, 1)
PROBS = [0.0, 0.1, 0.5, 0.95, 0.99, 1.0]


def nearest(values, p):
    s = sorted(values)
    return s[min(int(p * len(s)), len(s) - 1)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_nearest_ranks_against_sorting(spark, threshold):
    """Ties, negatives, zero, close values and one hot value that holds a third of all rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    r = random.Random(4)
    data = [("hot", 3.25)] * 700 + [("hot", r.uniform(0, 10)) for _ in range(1300)]
    data += [("wide", r.choice([-1, 1]) * 10 ** r.uniform(-6, 9)) for _ in range(500)] + [("wide", 0.0)] * 20
    data += [("near", 1 + i * 1e-12) for i in range(50)] + [("single", 7.0), ("nulls", None)]
    data += [("micros", 1.7e15 + i) for i in range(700)] + [("tiny", r.uniform(0, 2e-7)) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    got = {(x["g"], x["p"]): x["value"] for x in K.nearest_ranks(df, "v", PROBS, ["g"]).collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(g, p): nearest(vs, p) for g, vs in groups.items() for p in PROBS}


@pytest.mark.parametrize(("sketch", "step", "bracket_rows"), [(4096, 0.005, 4_000_000), (200, 0.05, 600)])
def test_nearest_ranks_of_values_near_zero_beside_a_large_one(spark, sketch, step, bracket_rows):
    """Whatever the distribution, also where brackets are narrowed again and again."""
    r = random.Random(6)
    data = [("a", r.uniform(0, 1e-9)) for _ in range(5000)] + [("a", 1e300), ("a", -1e300)] + [("b", float(i % 3)) for i in range(999)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    settings = {"sketch": sketch, "step": step, "bracket_rows": bracket_rows}
    got = {(x["g"], x["p"]): x["value"] for x in K.nearest_ranks(df, "v", PROBS, ["g"], **settings).collect()}
    assert got == {(g, p): nearest([v for h, v in data if h == g], p) for g in "ab" for p in PROBS}
    alone = {x["p"]: x["value"] for x in K.nearest_ranks(df, "v", PROBS, **settings).collect()}
    assert alone == {p: nearest([v for _, v in data], p) for p in PROBS}


def test_nearest_ranks_of_no_rows(spark):
    none = spark.createDataFrame([("a", None)], "g string, v double")
    assert K.nearest_ranks(none, "v", PROBS).count() == 0 and K.nearest_ranks(none, "v", PROBS, ["g"]).count() == 0


def test_nearest_ranks_without_groups(spark):
    df = spark.range(1001).select((F.col("id") % 500).cast("double").alias("v"))
    got = {x["p"]: x["value"] for x in K.nearest_ranks(df, "v", PROBS).collect()}
    assert got == {p: nearest([i % 500 for i in range(1001)], p) for p in PROBS}


def quantile(q, values, bounds):
    total = len(values)
    if not total:
        return None
    cums = [sum(v <= b for v in values) for b in bounds]
    for i, c in enumerate(cums):
        if c >= q * total:
            if i == 0:
                return bounds[0] if bounds[0] <= 0 else bounds[0] * q * total / c
            return bounds[i - 1] + (bounds[i] - bounds[i - 1]) * (q * total - cums[i - 1]) / (c - cums[i - 1])
    return bounds[-1]


@pytest.mark.parametrize("values, bounds", [
    ([], S.DURATION_BOUNDS), ([0.001], S.DURATION_BOUNDS), ([99.0] * 3, S.DURATION_BOUNDS),
    ([0.2, 0.3, 0.4, 3.0], S.DURATION_BOUNDS), ([0.0, 0.0, 7.0], S.PREDICTION_BOUNDS), ([5000.0], S.PREDICTION_BOUNDS),
    ([float(i) for i in range(200)], S.PREDICTION_BOUNDS)])
def test_bucket_quantile(spark, values, bounds):
    df = spark.createDataFrame([(v,) for v in values], "v double").agg(*bucket_counts(F.col("v"), bounds, "le"))
    for q in (0.5, 0.95):
        got = df.select(bucket_quantile(q, bounds, "le").alias("q")).first()["q"]
        want = quantile(q, values, bounds)
        assert got == want if want is None else got == pytest.approx(want)


def test_status_class(spark):
    df = spark.createDataFrame([(c,) for c in (100, 200, 299, 302, 404, 599, 600, 0)], "c int")
    got = [r["s"] for r in df.select(status_class(F.col("c")).alias("s")).collect()]
    assert got == ["other", "2xx", "2xx", "3xx", "4xx", "5xx", "other", "other"]


def minutes(spark, held):
    rows = [(T0 + dt.timedelta(minutes=m), v) for m, v in held.items()]
    return spark.createDataFrame(rows, "window_end timestamp, value double")


def test_sustained_needs_every_evaluation(spark):
    held = {m: 2.0 for m in range(0, 20)}
    held[8] = 0.5
    held[12] = None
    del held[15]
    got = {r["window_end"]: r["firing"] for r in R.sustained(minutes(spark, held), F.col("value") > 1, 3).collect()}
    for m in held:
        want = all((held.get(k) or 0) > 1 for k in range(m - 3, m + 1))
        assert got[T0 + dt.timedelta(minutes=m)] == want
    assert len(got) == len(held) and any(got.values())


def test_compare_with_earlier_floors_the_base_and_needs_one(spark):
    rows = [(T0, 0.01), (T0 + dt.timedelta(hours=1), 0.5), (T0 + dt.timedelta(hours=2), None), (T0 + dt.timedelta(minutes=5), 1.0)]
    df = spark.createDataFrame(rows, "window_end timestamp, value double")
    got = {r["window_end"].hour: r["ratio"] for r in R.compare_with_earlier(df, "value").collect()}
    assert got == {1: pytest.approx(5.0), 2: None}


def test_active_requests_against_a_loop(spark):
    r = random.Random(9)
    log = [(T0 + dt.timedelta(seconds=r.uniform(0, 3 * 86400)), r.uniform(0, 400)) for _ in range(400)]
    got = R.active_requests(spark.createDataFrame(log, "ts timestamp, duration_s double")).collect()
    assert len(got) > 300
    for row in r.sample(got, 60):
        end = row["step_end"]
        started = sum(ts < end for ts, _ in log)
        ended = sum(ts + dt.timedelta(microseconds=round(d * 1e6)) < end for ts, d in log)
        assert row["active"] == started - ended


def test_load_summary(spark):
    rows = [(200, 10.0, 5.0), (200, 30.0, 7.0), (200, 20.0, None), (500, 99.0, 1.0)]
    df = spark.createDataFrame(rows, "code int, elapsed_ms double, prediction double").withColumn("run", F.lit(1))
    r = R.load_summary(df, F.lit(2.0), ["run"]).first()
    assert (r["n_total"], r["n_ok"], r["n_failed"], r["success_pct"], r["throughput"]) == (4, 3, 1, 75.0, 2.0)
    assert (r["p50_ms"], r["p95_ms"], r["max_ms"], r["prediction_median"]) == (20.0, 30.0, 30.0, 7.0)
    none = R.load_summary(df.filter("code = 500"), F.lit(2.0), ["run"]).first()
    assert (none["n_ok"], none["p99_ms"], none["prediction_median"]) == (0, 0.0, None)


@pytest.mark.parametrize("payload, want", [
    ({"alerts": []}, ("unknown", "no firing alerts in payload")), ({}, ("unknown", "no firing alerts in payload")),
    ({"alerts": [{"status": "resolved"}, {"status": "firing", "labels": {"alertname": "x"}, "annotations": {"summary": "s" * 100}}]},
     ("x", "grafana_alert:x | " + "s" * 80)),
    ({"alerts": [{"status": "firing"}]}, ("unknown", "grafana_alert:unknown")),
    ({"alerts": [{"status": "firing", "labels": {"alertname": "y"}, "annotations": None}]}, ("y", "grafana_alert:y"))])
def test_alert_payload(spark, payload, want):
    df = spark.createDataFrame([(json.dumps(payload),)], "p string")
    parsed = L.parse_alert(F.col("p"))
    assert tuple(df.select(parsed["alert"], parsed["reason"]).first()) == want


def test_stability_index(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 10).cast("double").alias("y"))
    moved = base.select((F.col("x") + 400).alias("x"), "y")
    got = {r["feature"]: r for r in G.stability_index(base, moved, ["x", "y"]).collect()}
    assert got["x"]["drifted"] and not got["y"]["drifted"] and got["y"]["psi"] == pytest.approx(0.0)


def test_quantile_at_zero_is_where_the_first_filled_bucket_begins(spark):
    df = spark.createDataFrame([(0.2,), (0.3,)], "v double").agg(*bucket_counts(F.col("v"), S.DURATION_BOUNDS, "le"))
    low = max([b for b in S.DURATION_BOUNDS if b < 0.2], default=0.0)
    assert df.select(bucket_quantile(0.0, S.DURATION_BOUNDS, "le").alias("x")).first()["x"] == low
