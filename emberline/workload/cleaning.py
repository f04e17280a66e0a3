"""Cleaning, de-duplication and enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions import clean
from emberline.operators import cleaning as C
from emberline.operators import enrich as E
from emberline.plans import detections as T
from emberline.session import new_folder
from emberline.workload import standins as D
from emberline.workload.registry import query


def ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


@query("drop_incomplete", f"WITH {D.RAW_SQL} SELECT event_id, latitude, longitude, acq_date, acq_time, frp FROM raw "
       "WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND acq_date IS NOT NULL "
       "AND acq_time IS NOT NULL AND frp IS NOT NULL")
def _(spark, sf):
    raw = C.require_columns(D.raw_detections(spark, sf), S.DETECTION_REQUIRED, "detections")
    return C.drop_incomplete(raw, S.DETECTION_REQUIRED).select("event_id", *S.DETECTION_REQUIRED)


@query("coerce_numbers", f"WITH {D.RAW_SQL} SELECT event_id, latitude, longitude, frp FROM numbers")
def _(spark, sf):
    whole = C.drop_incomplete(D.raw_detections(spark, sf), S.DETECTION_REQUIRED)
    return C.coerce_numbers(whole, ["latitude", "longitude", "frp"]).select("event_id", "latitude", "longitude", "frp")


@query("normalise_confidence", f"WITH {D.RAW_SQL} SELECT event_id, lower({D.STRIPPED_SQL}) AS confidence FROM raw")
def _(spark, sf):
    return D.raw_detections(spark, sf).select("event_id", clean.clean_text(F.col("confidence")).alias("confidence"))


@query("domain_filter", f"WITH {D.RAW_SQL} SELECT event_id, latitude, longitude, frp FROM valid")
def _(spark, sf):
    whole = C.drop_incomplete(D.raw_detections(spark, sf), S.DETECTION_REQUIRED)
    return C.in_domain(C.coerce_numbers(whole, ["latitude", "longitude", "frp"])).select(
        "event_id", "latitude", "longitude", "frp")


@query("utc_timestamp", f"""WITH {D.RAW_SQL}
SELECT event_id, TRY_STRPTIME(acq_date || ' ' || lpad(acq_time, 4, '0'), '%Y-%m-%d %H%M') AS acq_datetime_utc
FROM raw WHERE TRY_STRPTIME(acq_date || ' ' || lpad(acq_time, 4, '0'), '%Y-%m-%d %H%M') IS NOT NULL""")
def _(spark, sf):
    return C.add_acquisition_times(D.raw_detections(spark, sf)).select("event_id", ntz("acq_datetime_utc"))


@query("local_time", f"WITH {D.det_sql()} SELECT event_id, acq_datetime_wib, acq_date_wib FROM det")
def _(spark, sf):
    det = D.detections(spark, sf).drop("acq_datetime_wib", "acq_date_wib")
    return C.add_local_times(det).select("event_id", ntz("acq_datetime_wib"), "acq_date_wib")


@query("hhmm_padding", f"""WITH {D.RAW_SQL}
SELECT acq_time, lpad(acq_time, 4, '0') AS padded, substring(lpad(acq_time, 4, '0'), 1, 2) AS hour_text,
  substring(lpad(acq_time, 4, '0'), 3, 2) AS minute_text, count(*) AS n
FROM raw GROUP BY acq_time""")
def _(spark, sf):
    padded = F.lpad("acq_time", 4, "0")
    return (D.raw_detections(spark, sf).groupBy("acq_time").agg(F.count(F.lit(1)).alias("n"))
            .select("acq_time", padded.alias("padded"), F.substring(padded, 1, 2).alias("hour_text"),
                    F.substring(padded, 3, 2).alias("minute_text"), "n"))


@query("detection_dedup", f"""WITH {D.det_sql()}, {D.DUP_SQL}
SELECT event_id, province_id, priority, frp FROM (
  SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_datetime_utc, satellite
    ORDER BY priority, event_id) AS rn FROM dup) WHERE rn = 1""")
def _(spark, sf):
    dup = D.with_duplicates(D.detections(spark, sf))
    return C.dedup_detections(dup, [F.col("priority"), F.col("event_id")]).select(
        "event_id", "province_id", "priority", "frp")


@query("clean_detections", f"""WITH {D.RAW_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_datetime_utc, satellite
    ORDER BY event_id) AS rn FROM timed)
SELECT latitude, longitude, acq_date, acq_time, frp, lower({D.STRIPPED_SQL}) AS confidence, daynight, satellite,
  province_id, acq_datetime_utc, acq_datetime_utc + INTERVAL 7 HOUR AS acq_datetime_wib,
  CAST(acq_datetime_utc + INTERVAL 7 HOUR AS DATE) AS acq_date_wib
FROM ranked WHERE rn = 1""")
def _(spark, sf):
    out = C.clean_detections(D.landed_raw(spark, sf), [F.col("event_id")])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("acq_datetime_utc", "acq_datetime_wib")})


@query("detection_projection", f"""WITH {D.det_sql()}
SELECT latitude, longitude, acq_date, frp, confidence, daynight, satellite, province_id, acq_datetime_utc,
  acq_datetime_wib, acq_date_wib FROM det""")
def _(spark, sf):
    out = C.project_detections(D.detections(spark, sf))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("acq_datetime_utc", "acq_datetime_wib")})


@query("weather_dates", f"""WITH {D.weather_sql()}
SELECT snapshot_id, province_id, date, precipitation_sum FROM snapshots WHERE snapshot_id % 11 <> 0""")
def _(spark, sf):
    bad = F.when(F.col("snapshot_id") % 11 == 0, "2024-02-31").otherwise(F.col("date"))
    return C.parse_weather(D.raw_weather(spark, sf).withColumn("date", bad)).select(
        "snapshot_id", "province_id", "date", "precipitation_sum")


@query("weather_dedup", f"""WITH {D.weather_sql()}
SELECT snapshot_id, province_id, date, fetched_at_utc, {', '.join(S.WEATHER)} FROM weather""")
def _(spark, sf):
    return C.clean_weather(D.raw_weather(spark, sf), [F.desc("snapshot_id")])


@query("weather_join", f"""WITH {D.det_sql()}, {D.weather_sql()}
SELECT d.event_id, d.province_id, d.acq_date_wib, {', '.join('w.' + c for c in S.WEATHER)}
FROM det d LEFT JOIN weather w ON d.province_id = w.province_id AND d.acq_date_wib = w.date""")
def _(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf), [F.desc("snapshot_id")])
    return E.join_weather(D.detections(spark, sf), weather).select(
        "event_id", "province_id", "acq_date_wib", *S.WEATHER)


@query("weather_unmatched", f"""WITH {D.det_sql()}, {D.weather_sql()}
SELECT d.province_id, count(*) AS n_unmatched
FROM det d LEFT JOIN weather w ON d.province_id = w.province_id AND d.acq_date_wib = w.date
WHERE w.date IS NULL GROUP BY d.province_id""")
def _(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf), [F.desc("snapshot_id")])
    return E.unmatched(D.detections(spark, sf), weather)


COUNTS_SQL = f"""WITH {D.RAW_SQL}
SELECT (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM numbers) AS n_complete, (SELECT count(*) FROM valid) AS n_valid,
  (SELECT count(*) FROM timed) AS n_timed,
  (SELECT count(*) FROM (SELECT DISTINCT latitude, longitude, acq_datetime_utc, satellite FROM timed)) AS n_distinct"""


@query("cleaning_counts", COUNTS_SQL)
def _(spark, sf):
    return C.cleaning_counts(D.raw_detections(spark, sf))


@query("cleaning_counts_observed", COUNTS_SQL)
def _(spark, sf):
    """Counts of the run that writes the cleaned rows."""
    rows, seen = C.clean_and_count(D.raw_detections(spark, sf), [F.col("event_id")])
    rows.write.parquet(new_folder(spark, "cleaned"))
    found = C.counts(seen)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{step} long" for step in found))


# Areas rank by their first letter, later ones first; `signup` is not in the area table. Every tenth detection comes from a second area.
@query("clean_by_area", f"""WITH {D.RAW_SQL},
dup AS (SELECT * FROM timed UNION ALL
  SELECT * REPLACE (CASE WHEN event_id % 20 = 0 THEN 'signup' ELSE 'view' END AS province_id) FROM timed WHERE event_id % 10 = 0),
areas AS (SELECT DISTINCT event_type AS province_id, 200 - ascii(event_type) AS priority FROM events WHERE event_type <> 'signup'),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY latitude, longitude, acq_datetime_utc, satellite
    ORDER BY coalesce(a.priority, 1000), event_id, d.province_id) AS rn FROM dup d LEFT JOIN areas a USING (province_id))
SELECT latitude, longitude, acq_datetime_utc, satellite, province_id, frp FROM ranked WHERE rn = 1""")
def _(spark, sf):
    raw = D.landed_raw(spark, sf)
    second = F.when(F.col("event_id") % 20 == 0, "signup").otherwise("view")
    dup = raw.unionByName(raw.filter(F.col("event_id") % 10 == 0).withColumn("province_id", second))
    areas = D.table(spark, sf, "events").filter("event_type <> 'signup'").select(
        F.col("event_type").alias("province_id"), (200 - F.ascii("event_type")).alias("priority"))
    out = T.clean_by_area(dup, areas, [F.col("event_id"), F.col("province_id")])
    return out.select("latitude", "longitude", ntz("acq_datetime_utc"), "satellite", "province_id", "frp")
