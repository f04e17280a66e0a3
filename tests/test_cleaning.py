from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions import clean
from emberline.operators import cleaning as C
from emberline.operators import enrich as E
from emberline.plans import detections as T
from emberline.session import new_folder


def one(spark, value, kind, fn):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, want", [
    ("12.5", 12.5), (" 7 ", 7.0), ("abc", None), ("NaN", None), (" nan ", None), ("", None), ("NA", None),
    (None, None), ("-1", -1.0), ("1.5d", None), ("2F", None), ("1e3", 1000.0)])
def test_clean_double(spark, text, want):
    assert one(spark, text, "string", clean.clean_double) == want


@pytest.mark.parametrize("date, hhmm, want", [
    ("2024-01-02", "5", "2024-01-02 00:05"), ("2024-01-02", "518", "2024-01-02 05:18"),
    ("2024-01-02", "1418", "2024-01-02 14:18"), ("2024-01-02", "518.0", "2024-01-02 05:18"),
    ("2024-01-02", "2460", None), ("2024-01-02", "1260", None), ("2024-01-02", "2400", None),
    ("2024-01-02", "141822", "2024-01-02 14:18"), ("2024-01-02", "-5", None), ("2024-01-02", "NaN", None),
    ("2024-01-02", None, None), ("2024-02-30", "518", None), ("2024", "518", None), ("x", "518", None),
    ("2024-01-02", "0", "2024-01-02 00:00"), ("2024-01-02", "2359", "2024-01-02 23:59")])
def test_utc_timestamp(spark, date, hhmm, want):
    df = spark.createDataFrame([(date, hhmm)], "d string, h string")
    got = df.select(F.date_format(clean.utc_timestamp(F.col("d"), F.col("h")), "yyyy-MM-dd HH:mm").alias("r")).first()["r"]
    assert got == want


def test_clip_keeps_null(spark):
    assert one(spark, None, "double", lambda c: clean.clip(c, 0.0, 5.0)) is None
    assert one(spark, 9.0, "double", lambda c: clean.clip(c, 0.0, 5.0)) == 5.0


def raw(spark, rows):
    return spark.createDataFrame(rows, "latitude string, longitude string, acq_date string, acq_time string, frp string, "
                                       "confidence string, satellite string, province_id string, priority int")


def test_edges_of_the_domain(spark):
    base = ("110.0", "2024-01-01", "100", "1.0", "h", "N", "a", 1)
    rows = [("90", *base), ("90.01", *base), ("NaN", *base), ("abc", *base), (None, *base),
            ("-90", "110.0", "2024-01-01", "100", "0", "h", "N", "a", 1),
            ("1", "110.0", "2024-01-01", "100", "-1", "h", "N", "a", 1),
            ("2", "110.0", "2024-01-01", "100", "NaN", "h", "N", "a", 1)]
    got = C.clean_detections(raw(spark, rows), [F.col("priority")])
    assert sorted(r["latitude"] for r in got.collect()) == [-90.0, 90.0]


def test_local_day_rolls_over_at_17_utc(spark):
    rows = [("1", "1", "2024-01-31", "1659", "1", " H ", "N", "a", 1), ("2", "1", "2024-01-31", "1700", "1", None, "N", "a", 1)]
    got = {r["latitude"]: r for r in C.clean_detections(raw(spark, rows), [F.col("priority")]).collect()}
    assert got[1.0]["acq_date_wib"] == dt.date(2024, 1, 31)
    assert got[2.0]["acq_date_wib"] == dt.date(2024, 2, 1)
    assert got[1.0]["confidence"] == "h" and got[2.0]["confidence"] is None


def test_duplicate_in_two_areas_goes_to_the_first_priority(spark):
    rows = [("1", "1", "2024-01-01", "100", "1", "h", "N", area, p) for area, p in (("late", 2), ("early", 1), ("last", 3))]
    got = C.clean_detections(raw(spark, rows), [F.col("priority")]).collect()
    assert [r[S.ENTITY] for r in got] == ["early"]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['acq_time', 'frp'\]"):
        C.clean_detections(spark.createDataFrame([("1", "1", "d")], "latitude string, longitude string, acq_date string"), [])


def test_hot_duplicate_is_cut_before_the_shuffle(spark, plan):
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, 0).otherwise(F.col("id")).cast("double").alias("latitude"),
        F.lit(1.0).alias("longitude"), F.lit("2024-01-01").cast("timestamp").alias("acq_datetime_utc"),
        F.lit("N").alias("satellite"), F.col("id").alias("event_id"))
    out = C.dedup_detections(df, [F.col("event_id")])
    text = plan(out)
    assert text.index("WindowGroupLimit", text.index("Exchange")) > 0, "no limit below the shuffle"
    assert out.count() == n - n // 3 + 1


def weather(spark, rows):
    return spark.createDataFrame(rows, "province_id string, date string, precipitation_sum string, fetched_at_utc string, file_name string")


def test_weather_without_stamp_wins_and_ties_break_by_file(spark):
    rows = [("a", "2024-01-01", "1", "2024-01-05", "f1"), ("a", "2024-01-01", "2", None, "f2"),
            ("b", "2024-01-01", "3", "2024-01-05", "f1"), ("b", "2024-01-01", "4", "2024-01-05", "f2"),
            ("c", "bad", "5", None, "f1"), ("d", "2024-01-02 00:00:00", "x", None, "f1")]
    got = {r["province_id"]: r["precipitation_sum"] for r in
           C.clean_weather(weather(spark, rows), [F.desc("file_name")]).collect()}
    assert got == {"a": 2.0, "b": 4.0, "d": None}


def detections(spark, n=6):
    return spark.range(n).select(
        F.lit("a").alias("province_id"), F.col("id").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"),
        F.lit("2024-01-01").cast("timestamp").alias("acq_datetime_utc"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("acq_date_wib"))


def test_join_is_left_and_validated(spark):
    one_day = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.5)], "province_id string, date date, precipitation_sum double")
    got = E.join_weather(detections(spark), one_day)
    assert got.count() == 6 and got.filter("precipitation_sum is null").count() == 3
    with pytest.raises(Exception, match="more than one row for a key"):
        E.join_weather(detections(spark), one_day.union(one_day)).collect()
    assert E.join_weather(detections(spark), None).columns == detections(spark).columns


def test_salt_spreads_a_hot_day_over_shuffled_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = detections(spark, 4000).withColumn("acq_date_wib", F.lit("2024-01-01").cast("date"))
        one_day = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.5)], "province_id string, date date, precipitation_sum double")
        sizes = [r["n"] for r in E.join_weather(hot, one_day).groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 4000 and len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_counts_come_from_the_run_that_writes(spark):
    good = ("1.0", "2.0", "2024-01-01", "518", "3", "N", "a")
    bad = [(None, *good[1:]), ("95", *good[1:]), ("x", *good[1:]), (*good[:3], "2575", *good[4:])]
    raw = spark.createDataFrame([good] * 3 + bad, "latitude string, longitude string, acq_date string, acq_time string, frp string, satellite string, province_id string")
    rows, seen = C.clean_and_count(raw.repartition(3), [F.col("province_id")])
    rows.write.parquet(new_folder(spark, "counted"))
    got = C.counts(seen)
    assert got == {"n_raw": 7, "n_complete": 6, "n_valid": 4, "n_timed": 3, "n_distinct": 1}
    assert C.cleaning_counts(raw).first().asDict() == got
    empty, seen = C.clean_and_count(raw.limit(0), [F.col("province_id")])
    empty.write.parquet(new_folder(spark, "counted"))
    assert set(C.counts(seen).values()) == {0}


def test_the_area_with_the_lowest_priority_keeps_a_shared_detection(spark):
    def row(lat, area, frp="3"):
        return (lat, "2.0", "2024-01-01", "518", frp, "N", area)
    raw = spark.createDataFrame([row("1", "b"), row("1", "a"), row("1", "none"), row("2", None), row("2", "none"), row("3", "none"), row("3", "b")],
                                "latitude string, longitude string, acq_date string, acq_time string, frp string, satellite string, province_id string")
    areas = spark.createDataFrame([("a", 1), ("b", 5), ("b", 0)], "province_id string, priority int")
    got = T.clean_by_area(raw, areas, [F.asc_nulls_first("province_id")])
    assert sorted((r["latitude"], r["province_id"]) for r in got.collect()) == [(1.0, "b"), (2.0, None), (3.0, "b")]
    assert "_priority" not in got.columns and T.clean_by_area(raw.limit(0), areas.limit(0), [F.col("province_id")]).count() == 0
