from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import daily as A
from emberline.operators import targets as T
from emberline.operators import windows as W
from emberline.plans import features as P

DAY = dt.date(2024, 1, 1)
SCHEMA = "province_id string, date date, hotspot_count long, frp_mean double, precipitation_sum double"


def random_series(seed, entities=12):
    """Sparse series with gaps, null means and null rain."""
    r = random.Random(seed)
    out = []
    for e in range(entities):
        day = DAY + dt.timedelta(days=r.randrange(5))
        for _ in range(r.randrange(1, 25)):
            out.append((f"e{e}", day, r.randrange(1, 30), r.choice([None, r.random() * 50]),
                        r.choice([None, 0.0, 0.99, 1.0, 5.0])))
            day += dt.timedelta(days=r.choice([1, 1, 1, 2, 5]))
    return out


def by_entity(rows):
    out = {}
    for row in sorted(rows):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_training_windows_against_a_plain_loop(spark, seed):
    rows = random_series(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = T.add_targets(W.add_days_since_rain(W.add_lags(W.add_rolling(df))))
    got = {(r[S.ENTITY], r["date"]): r for r in df.collect()}
    assert len(got) == len(rows)
    for series in by_entity(rows).values():
        dry, rained = 0, False
        for i, (e, day, n, _, rain) in enumerate(series):
            r = got[(e, day)]
            for w in S.WINDOWS:
                before = series[max(0, i - w):i]
                assert r[f"hotspot_count_{w}d"] == (sum(b[2] for b in before) if before else None)
                means = [b[3] for b in before if b[3] is not None]
                if means:
                    assert math.isclose(r[f"frp_mean_{w}d"], sum(means) / len(means))
                else:
                    assert r[f"frp_mean_{w}d"] is None
                assert r[f"hotspot_count_lag_{w}d"] == (series[i - w][2] if i >= w else None)
            if rain is not None and rain >= 1.0:
                dry, rained = 0, True
            elif rained:
                dry += 1
            assert r["days_since_rain"] == dry
            following = series[i + 1][2] if i + 1 < len(series) else None
            assert r[S.TARGET_COUNT] == following
            assert r[S.TARGET_CLASS] == (-1 if following is None else 0 if following <= 0 else 1 if following <= 10 else 2)


@pytest.mark.parametrize("seed", [3])
def test_serving_windows_are_calendar_based(spark, seed):
    r = random.Random(seed)
    det = [(f"e{r.randrange(4)}", DAY + dt.timedelta(days=r.randrange(20)), r.choice([None, r.random() * 9]), "d", "H")
           for _ in range(150)]
    df = spark.createDataFrame(det, "province_id string, acq_date date, frp double, daynight string, confidence string")
    for row in W.add_serving_windows(W.serving_daily(df)).collect():
        mine = [x for x in det if x[0] == row[S.ENTITY]]
        for d in S.WINDOWS:
            inside = [x for x in mine if row["date"] - dt.timedelta(days=d) < x[1] <= row["date"]]
            power = [x[2] for x in inside if x[2] is not None]
            assert row[f"hotspot_count_{d}d"] == len(inside)
            assert math.isclose(row[f"frp_mean_{d}d"], sum(power) / len(power) if power else 0.0)
            assert row[f"hotspot_count_lag_{d}d"] == sum(x[1] == row["date"] - dt.timedelta(days=d) for x in mine)


def test_one_shuffle_and_sort_for_all_training_windows(spark, plan):
    df = spark.createDataFrame(random_series(1), SCHEMA)
    text = plan(T.add_targets(W.add_days_since_rain(W.add_lags(W.add_rolling(df)))))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_aggregate_counts_null_power_and_sums_to_zero(spark):
    rows = [("a", DAY, None, "d", "H"), ("a", DAY, None, "N", None), (None, DAY, 1.0, "D", "h"), ("b", None, 1.0, "D", "h")]
    df = spark.createDataFrame(rows, "province_id string, acq_date_wib date, frp double, daynight string, confidence string")
    got = A.aggregate_daily(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["hotspot_count"], r["frp_sum"], r["frp_mean"]) == (2, 0.0, None)
    assert (r["n_daytime"], r["n_nighttime"], r["n_confidence_high"]) == (1, 1, 1)


def test_days_since_rain_without_the_column(spark):
    df = spark.createDataFrame(random_series(1), SCHEMA).drop("precipitation_sum")
    assert W.add_days_since_rain(df).filter("days_since_rain is not null").isEmpty()


def test_dense_mode_makes_class_zero_possible(spark):
    det = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY + dt.timedelta(days=3), 2.0), ("one", DAY, 1.0)],
                                "province_id string, acq_date_wib date, frp double")
    sparse = P.training_table(det)
    dense = P.training_table(det, dense=True)
    assert [(r["date"].day, r[S.TARGET_CLASS]) for r in sparse.collect()] == [(1, 1)]
    assert sorted((r["date"].day, r[S.TARGET_CLASS]) for r in dense.collect()) == [(1, 0), (2, 0), (3, 1)]


def test_last_day_is_kept_for_scoring(spark):
    det = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY + dt.timedelta(days=1), 2.0)],
                                "province_id string, acq_date_wib date, frp double")
    assert P.training_table(det).count() == 1
    latest = W.latest_per_entity(P.daily_features(det)).collect()
    assert [r["date"].day for r in latest] == [2]


def test_joining_weather_to_days_equals_joining_it_to_detections(spark):
    from emberline.operators.enrich import join_weather
    det = spark.range(200).select(
        (F.col("id") % 3).cast("string").alias("province_id"), (F.col("id") * 1.5).alias("frp"),
        F.col("id").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"),
        F.lit("2024-01-01").cast("timestamp").alias("acq_datetime_utc"),
        F.date_add(F.lit(DAY), (F.col("id") % 5).cast("int")).alias("acq_date_wib"))
    weather = spark.range(12).select((F.col("id") % 3).cast("string").alias("province_id"),
                                     F.date_add(F.lit(DAY), (F.col("id") / 3).cast("int")).alias("date"),
                                     F.col("id").cast("double").alias("precipitation_sum"))
    early = A.aggregate_daily(join_weather(det, weather)).select("province_id", "date", "hotspot_count", "precipitation_sum")
    late = A.join_daily_weather(A.aggregate_daily(det), weather).select("province_id", "date", "hotspot_count", "precipitation_sum")
    assert sorted(early.collect(), key=str) == sorted(late.collect(), key=str)


def test_weather_that_repeats_a_key_fails_the_daily_join(spark):
    daily = spark.createDataFrame([("a", dt.date(2024, 1, 1), 3)], "province_id string, date date, hotspot_count long")
    weather = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 1), 2.0)], "province_id string, date date, precipitation_sum double")
    with pytest.raises(Exception, match="more than one row for a key"):
        A.join_daily_weather(daily, weather).collect()
