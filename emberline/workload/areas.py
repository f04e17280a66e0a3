"""Area dimension, fetch plan and point-in-box queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.calendar import inclusive_days
from emberline.operators import spatial as X
from emberline.sources import areas as A
from emberline.workload import standins as D
from emberline.workload.registry import query

BOX_VALUES = ", ".join(
    f"({i}, '{a[0]}', CAST({a[2]} AS DOUBLE), CAST({a[3]} AS DOUBLE), CAST({a[4]} AS DOUBLE), CAST({a[5]} AS DOUBLE))"
    for i, a in enumerate(S.AREAS, 1))
BOX_SQL = f"boxes(priority, area, lat_min, lon_min, lat_max, lon_max) AS (VALUES {BOX_VALUES})"
ASSIGNED_SQL = """assigned AS (
  SELECT d.event_id, d.acq_date, d.latitude, d.longitude, d.frp, arg_min(b.area, b.priority) AS area
  FROM det d LEFT JOIN boxes b ON d.latitude BETWEEN b.lat_min AND b.lat_max AND d.longitude BETWEEN b.lon_min AND b.lon_max
  GROUP BY ALL)"""


def assigned(spark, sf):
    return X.assign_few(D.detections(spark, sf), X.configured_boxes(), "area")


@query("point_in_box_few", f"WITH {D.det_sql()}, {BOX_SQL}, {ASSIGNED_SQL} SELECT event_id, area FROM assigned")
def _(spark, sf):
    return assigned(spark, sf).select("event_id", "area")


@query("point_in_box_many", f"""WITH {D.det_sql()}, {D.AREA_SQL},
boxes AS (SELECT province_id AS area, * EXCLUDE (province_id) FROM areas), {ASSIGNED_SQL}
SELECT event_id, area FROM assigned""")
def _(spark, sf):
    return X.assign_many(D.detections(spark, sf), D.area_table(spark, sf), out="area").select("event_id", "area")


@query("box_coverage", f"""WITH {D.det_sql()}, {BOX_SQL}, {ASSIGNED_SQL}
SELECT count(*) AS n_rows, count(area) AS n_inside, min(acq_date) FILTER (area IS NOT NULL) AS first_date,
  max(acq_date) FILTER (area IS NOT NULL) AS last_date, round(count(area) / greatest(1, count(*)), 8) AS share
FROM assigned""")
def _(spark, sf):
    out = X.coverage(assigned(spark, sf), "area")
    return out.withColumn("share", F.round("share", 8))


@query("split_manifest", f"""WITH {D.det_sql()}, {D.AREA_SQL},
boxes AS (SELECT province_id AS area, * EXCLUDE (province_id) FROM areas), {ASSIGNED_SQL}
SELECT a.province_id, count(s.area) AS n_rows, min(s.acq_date) AS first_date, max(s.acq_date) AS last_date
FROM areas a LEFT JOIN assigned s ON s.area = a.province_id GROUP BY a.province_id""")
def _(spark, sf):
    areas = D.area_table(spark, sf)
    return X.split_manifest(X.assign_many(D.detections(spark, sf), areas), areas)


@query("area_selection", f"""WITH {D.AREA_SQL}
SELECT priority, province_id, name FROM areas WHERE lower(province_id) IN ('a1', 'a3', 'a5')""")
def _(spark, sf):
    return A.select_areas(D.area_table(spark, sf), ["A1", "a3", "a5"]).select("priority", "province_id", "name")


@query("box_validity", f"""WITH {D.AREA_SQL}
SELECT province_id, coalesce(lat_min >= -90 AND lat_min < lat_max AND lat_max <= 90
  AND lon_min >= -180 AND lon_min < lon_max AND lon_max <= 180, false) AS valid FROM areas""")
def _(spark, sf):
    return D.area_table(spark, sf).select("province_id", A.valid_box().alias("valid"))


@query("box_centroid", f"""WITH {D.AREA_SQL}
SELECT province_id, round((lat_min + lat_max) / 2, 8) AS lat, round((lon_min + lon_max) / 2, 8) AS lon FROM areas""")
def _(spark, sf):
    return A.add_centroid(D.area_table(spark, sf)).select(
        "province_id", F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"))


@query("coordinate_text", """SELECT event_id, printf('%.4f', CAST(-5.5 AS DOUBLE) + (event_id * 37 % 1000) / CAST(100 AS DOUBLE)) AS lat_text
FROM events""")
def _(spark, sf):
    return D.detections(spark, sf).select("event_id", A.coordinate_text(F.col("latitude")).alias("lat_text"))


# Each user's first to last day is the window to fetch.
@query("fetch_chunks", f"""WITH {D.det_sql('user')},
span AS (SELECT province_id, min(acq_date) AS s, max(acq_date) AS e FROM det GROUP BY province_id),
starts AS (SELECT province_id, s, e, CAST(unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 5 DAY)) AS DATE) AS chunk_start FROM span)
SELECT province_id, chunk_start, least(CAST(chunk_start + 4 AS DATE), e) AS chunk_end,
  CAST(least(CAST(chunk_start + 4 AS DATE), e) - chunk_start + 1 AS INTEGER) AS days,
  DATE '2024-03-05' - s > 60 AS old_start
FROM starts""")
def _(spark, sf):
    span = D.detections(spark, sf, "user").groupBy("province_id").agg(
        F.min("acq_date").alias("start"), F.max("acq_date").alias("end"))
    return A.chunk_windows(span, today=F.lit("2024-03-05").cast("date")).select(
        "province_id", "chunk_start", "chunk_end", "days", "old_start")


# The same twelve days for every area of the table.
@query("fetch_plan", f"""WITH {D.AREA_SQL},
starts AS (SELECT unnest([DATE '2024-01-01', DATE '2024-01-06', DATE '2024-01-11']) AS chunk_start)
SELECT province_id, chunk_start, least(CAST(chunk_start + 4 AS DATE), DATE '2024-01-12') AS chunk_end,
  CAST(least(CAST(chunk_start + 4 AS DATE), DATE '2024-01-12') - chunk_start + 1 AS INTEGER) AS days,
  round((lat_min + lat_max) / 2, 8) AS lat, round((lon_min + lon_max) / 2, 8) AS lon
FROM areas, starts""")
def _(spark, sf):
    plan = A.fetch_plan(spark, D.area_table(spark, sf), date(2024, 1, 1), date(2024, 1, 12))
    return plan.select("province_id", "chunk_start", "chunk_end", "days", F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"))


@query("inclusive_days", f"""WITH {D.det_sql('user')}
SELECT province_id, CAST(max(acq_date) - min(acq_date) + 1 AS INTEGER) AS n_days FROM det GROUP BY province_id""")
def _(spark, sf):
    return D.detections(spark, sf, "user").groupBy("province_id").agg(
        inclusive_days(F.min("acq_date"), F.max("acq_date")).alias("n_days"))
