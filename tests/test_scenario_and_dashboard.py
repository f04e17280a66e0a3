from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import dashboard as B
from emberline.operators import scenario as X
from emberline.operators import scoring as P

DAY = dt.date(2024, 1, 1)


def features(spark):
    row = {"province_id": "a", "date": DAY, "hotspot_count": 10, "frp_mean": 4.0, "frp_max": None, "precipitation_sum": 490.0,
           "relative_humidity_2m_mean": 95.0, "temperature_2m_max": 49.0, "temperature_2m_min": 20.0, "windspeed_10m_max": 5.0,
           "days_since_rain": 85, "hotspot_count_1d": 3.0}
    types = ("province_id string, date date, hotspot_count long, frp_mean double, frp_max double, precipitation_sum double, "
             "relative_humidity_2m_mean double, temperature_2m_max double, temperature_2m_min double, windspeed_10m_max double, "
             "days_since_rain long, hotspot_count_1d double")
    return spark.createDataFrame([tuple(row.values())], types)


def test_drought_is_clamped(spark):
    r = X.run_scenario(features(spark), "drought").first()
    assert r["temperature_2m_max"] == 50.0 and r["days_since_rain"] == 90 and r["frp_max"] is None
    assert r["precipitation_sum"] == pytest.approx(147.0) and r["hotspot_count"] == pytest.approx(13.5)
    assert r["hotspot_count_1d"] == pytest.approx(3.75)


def test_wet_is_clamped_and_never_negative(spark):
    r = X.run_scenario(features(spark), "wet", 3.0).first()
    assert r["precipitation_sum"] == 500.0 and r["relative_humidity_2m_mean"] == 100.0
    assert r["frp_mean"] == 0.0 and r["hotspot_count_1d"] == 0.0 and r["days_since_rain"] == 0


def test_dry_days_round_half_to_even(spark):
    for start, want in ((2, 6), (3, 6)):
        df = features(spark).withColumn("days_since_rain", F.lit(start).cast("long"))
        assert X.drought(df, 0.25).first()["days_since_rain"] == want


def test_mixed_does_not_depend_on_partitioning(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("province_id"), F.lit(DAY).alias("date"), F.lit(100.0).alias("frp_mean"))
    one = {r["province_id"]: r["frp_mean"] for r in X.mixed(df.coalesce(1)).collect()}
    many = {r["province_id"]: r["frp_mean"] for r in X.mixed(df.repartition(7)).collect()}
    assert one == many and all(85 <= v <= 115 for v in one.values()) and len(set(one.values())) > 190
    assert one != {r["province_id"]: r["frp_mean"] for r in X.mixed(df, seed=7).collect()}


def test_summary_of_a_zero_base(spark):
    df = spark.createDataFrame([(0.0, 2.0)], "a double, b double")
    got = {r["column"]: r["delta_pct"] for r in X.summarize_shift(df, lambda t: t.withColumns({"a": F.col("a") + 1, "b": F.col("b") * 2}), ["a", "b", "c"]).collect()}
    assert got == {"a": 0.0, "b": 100.0}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "event_id")
    a = {r["event_id"] for r in B.fixed_sample(df, 100).collect()}
    b = {r["event_id"] for r in B.fixed_sample(df.repartition(9), 100).collect()}
    assert a == b and len(a) == 100 and B.fixed_sample(df, 5000).count() == 1000


def hotspots(spark):
    rows = [("a", DAY, "l", 0.0), ("a", DAY + dt.timedelta(days=9), "h", 40.0), ("b", DAY + dt.timedelta(days=40), "x", None),
            ("b", DAY + dt.timedelta(days=40), "n", 500.0)]
    return spark.createDataFrame(rows, "province_id string, acq_date date, confidence string, frp double")


def test_markers(spark):
    got = {(r["confidence"]): (r["age_days"], r["opacity"], r["radius"]) for r in B.markers(hotspots(spark)).collect()}
    assert got["l"] == (40, 0.4, 3.0) and got["x"] == (0, 1.0, 3.0) and got["n"] == (0, 1.0, 12.0)
    assert got["h"] == (31, 0.4, 5.0)


def test_filter(spark):
    df = hotspots(spark)
    assert B.filter_hotspots(df, DAY, DAY + dt.timedelta(days=40)).count() == 4
    assert B.filter_hotspots(df, DAY, DAY + dt.timedelta(days=40), [], "nominal").count() == 2
    assert B.filter_hotspots(df, DAY, DAY + dt.timedelta(days=40), ["b"], "high").count() == 0
    assert B.filter_hotspots(df, DAY, DAY, min_confidence="other").count() == 1
    assert B.in_default_range(df).count() == 2


def test_newest_day_is_global(spark):
    forecast = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "province_id string, prediction double")
    got = {r["province_id"]: r["today_count"] for r in B.newest_day_table(hotspots(spark), forecast).collect()}
    assert got == {"a": 0, "b": 2}


def test_sample_predictions_have_the_published_labels(spark):
    df = spark.createDataFrame([(12.82,), (7.58,), (5.92,), (0.0,), (10.0,), (-1.0,), (None,)], "prediction_count double")
    got = [(r["risk_level"], r["risk_label"]) for r in P.add_risk(df).collect()]
    assert got == [(2, "Bahaya"), (1, "Waspada"), (1, "Waspada"), (0, "Aman"), (1, "Waspada"), (0, "Aman"), (None, None)]


def test_encoding_fills_and_casts(spark):
    got = P.encode_features(spark.createDataFrame([("a", 5, None)], "province_id string, hotspot_count int, frp_mean double"), ["province_id"])
    assert got.columns[1:] == S.FEATURES and dict(got.dtypes)["month"] == "int" and dict(got.dtypes)["hotspot_count"] == "bigint"
    r = got.first()
    assert r["hotspot_count"] == 5 and r["frp_mean"] == 0.0


def test_totals_skip_failed_predictions(spark):
    df = spark.createDataFrame([(3, 1.5), (100, None), (2, 2.5)], "today_count long, prediction_count double")
    assert tuple(P.prediction_totals(df).first()) == (5, 4.0)
    assert tuple(P.prediction_totals(df.filter("prediction_count is null")).first()) == (0, 0.0)


def test_sketches_of_days_merge(spark):
    rows = spark.range(20000).select((F.col("id") % 10).alias("day"), (F.col("id") % 7000).alias("k"), F.when(F.col("id") < 0, 1).alias("none"))
    days = B.distinct_sketches(rows, ["k", "none"], "day")
    assert days.count() == 10
    all_days, half = B.merged_distinct(days, ["k", "none"]).first(), B.merged_distinct(days.filter("day < 5"), ["k"]).first()
    exact = rows.filter("day < 5").select("k").distinct().count()
    assert abs(all_days["n_k"] - 7000) <= 350 and abs(half["n_k"] - exact) <= 0.05 * exact and all_days["n_none"] == 0
    assert B.merged_distinct(days.limit(0), ["k"]).first()["n_k"] == 0
