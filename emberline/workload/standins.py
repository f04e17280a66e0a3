"""The roles of the data model, derived from the test tables by plain arithmetic.

Each function has a SQL twin that yields the same rows; both read whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.session import new_folder

TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of() -> Column:
    """The number in `props`, which reads {"k": 12}; cheaper than parsing the JSON."""
    return F.substring_index(F.substring_index("props", ": ", -1), "}", 1).cast("int")


def status_code() -> Column:
    """From a column `k`: one in twenty each of 503, 404, 302 and 102, else 200."""
    codes = F.array(*[F.lit(c) for c in (503, 404, 302, 102)])
    return F.coalesce(F.get(codes, F.col("k") % 20), F.lit(200))


def _entity(kind: str) -> Column:
    return {
        "type": F.col("event_type"),
        "user": F.col("user_id").cast("string"),
        "group": (F.col("user_id") % 30).cast("string"),
    }[kind]


ENTITY_SQL = {
    "type": "event_type",
    "user": "CAST(user_id AS VARCHAR)",
    "group": "CAST(user_id % 30 AS VARCHAR)",
}


def from_events(events: DataFrame, entity: str = "type") -> DataFrame:
    utc = F.col("ts").cast("timestamp")
    local = utc + F.expr("interval 7 hours")
    k = F.col("k")
    return events.withColumn("k", k_of()).select(
        "event_id", "user_id",
        _entity(entity).alias("province_id"),
        (F.lit(-5.5) + (F.col("event_id") * 37 % 1000) / F.lit(100.0)).alias("latitude"),
        (F.lit(100.0) + (F.col("event_id") * 53 % 1800) / F.lit(100.0)).alias("longitude"),
        utc.alias("acq_datetime_utc"), local.alias("acq_datetime_wib"),
        F.to_date(utc).alias("acq_date"), F.to_date(local).alias("acq_date_wib"),
        F.col("value").alias("frp"),
        F.when(k % 3 == 0, "l").when(k % 3 == 1, "n").otherwise("h").alias("confidence"),
        F.when(F.hour(utc).between(6, 17), "D").otherwise("N").alias("daynight"),
        F.when(F.col("event_id") % 2 == 0, "N").otherwise("1").alias("satellite"),
        "k")


def detections(spark: SparkSession, sf_dir: str, entity: str = "type") -> DataFrame:
    return from_events(table(spark, sf_dir, "events"), entity)


def det_sql(entity: str = "type", name: str = "det") -> str:
    return f"""{name} AS (
  SELECT event_id, user_id, {ENTITY_SQL[entity]} AS province_id,
    CAST(-5.5 AS DOUBLE) + (event_id * 37 % 1000) / CAST(100 AS DOUBLE) AS latitude,
    CAST(100 AS DOUBLE) + (event_id * 53 % 1800) / CAST(100 AS DOUBLE) AS longitude,
    ts AS acq_datetime_utc, ts + INTERVAL 7 HOUR AS acq_datetime_wib,
    CAST(ts AS DATE) AS acq_date, CAST(ts + INTERVAL 7 HOUR AS DATE) AS acq_date_wib,
    value AS frp,
    CASE CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 3 WHEN 0 THEN 'l' WHEN 1 THEN 'n' ELSE 'h' END AS confidence,
    CASE WHEN extract(hour FROM ts) BETWEEN 6 AND 17 THEN 'D' ELSE 'N' END AS daynight,
    CASE WHEN event_id % 2 = 0 THEN 'N' ELSE '1' END AS satellite,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events)"""


def with_duplicates(det: DataFrame) -> DataFrame:
    """Every tenth detection a second time, from another area; half of the copies rank first."""
    copies = det.filter(F.col("event_id") % 10 == 0)
    return det.withColumn("priority", F.lit(1)).unionByName(
        copies.withColumns({
            "priority": F.when(F.col("event_id") % 20 == 0, 0).otherwise(2),
            "province_id": F.concat(F.lit("x"), F.col("province_id"))}))


DUP_SQL = """dup AS (
  SELECT *, 1 AS priority FROM det
  UNION ALL
  SELECT * REPLACE ('x' || province_id AS province_id),
    CASE WHEN event_id % 20 = 0 THEN 0 ELSE 2 END AS priority
  FROM det WHERE event_id % 10 = 0)"""


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns as a CSV scan would give them, with bad cells mixed in."""
    e = F.col("event_id")
    utc = F.col("ts").cast("timestamp")
    lat = F.concat((e * 37 % 95).cast("string"), F.lit("."), F.lpad((e % 100).cast("string"), 2, "0"))
    lon = F.concat((e * 53 % 185).cast("string"), F.lit("."), F.lpad((e % 10).cast("string"), 2, "0"))
    frp = F.concat((e * 7 % 90).cast("string"), F.lit("."), F.lpad((e % 100).cast("string"), 2, "0"))
    hhmm = (F.hour(utc) * 100 + F.minute(utc)).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("province_id"),
        F.when(e % 97 == 0, "abc").when(e % 89 == 0, " NaN ").when(e % 83 != 0, lat).alias("latitude"),
        F.when(e % 101 == 0, "n/a").otherwise(lon).alias("longitude"),
        F.when(e % 71 == 0, "2024-13-01").otherwise(F.date_format(utc, "yyyy-MM-dd")).alias("acq_date"),
        F.when(e % 73 == 0, "2460").when(e % 79 != 0, hhmm).alias("acq_time"),
        F.when(e % 67 == 0, "-1.5").when(e % 61 == 0, "NaN").otherwise(frp).alias("frp"),
        F.when(e % 9 == 0, "\tH\u00a0").when(e % 3 == 0, " H ").when(e % 3 == 1, "n").otherwise(F.lit(None).cast("string")).alias("confidence"),
        F.when(e % 2 == 0, "D").otherwise("n").alias("daynight"),
        F.when(e % 2 == 0, "N").otherwise("1").alias("satellite"))


def landed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw detections as a stored table: plain columns, as after a file scan."""
    folder = new_folder(spark, "raw")
    raw_detections(spark, sf_dir).write.parquet(folder)
    return spark.read.parquet(folder)


#: Confidence without white space of any kind at either end.
STRIPPED_SQL = r"regexp_replace(confidence, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')"

RAW_SQL = """raw AS (
  SELECT event_id, event_type AS province_id,
    CASE WHEN event_id % 97 = 0 THEN 'abc' WHEN event_id % 89 = 0 THEN ' NaN ' WHEN event_id % 83 <> 0
      THEN CAST(event_id * 37 % 95 AS VARCHAR) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') END AS latitude,
    CASE WHEN event_id % 101 = 0 THEN 'n/a'
      ELSE CAST(event_id * 53 % 185 AS VARCHAR) || '.' || lpad(CAST(event_id % 10 AS VARCHAR), 2, '0') END AS longitude,
    CASE WHEN event_id % 71 = 0 THEN '2024-13-01' ELSE strftime(ts, '%Y-%m-%d') END AS acq_date,
    CASE WHEN event_id % 73 = 0 THEN '2460' WHEN event_id % 79 <> 0
      THEN CAST(extract(hour FROM ts) * 100 + extract(minute FROM ts) AS VARCHAR) END AS acq_time,
    CASE WHEN event_id % 67 = 0 THEN '-1.5' WHEN event_id % 61 = 0 THEN 'NaN'
      ELSE CAST(event_id * 7 % 90 AS VARCHAR) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') END AS frp,
    CASE WHEN event_id % 9 = 0 THEN chr(9) || 'H' || chr(160) WHEN event_id % 3 = 0 THEN ' H ' WHEN event_id % 3 = 1 THEN 'n' END AS confidence,
    CASE WHEN event_id % 2 = 0 THEN 'D' ELSE 'n' END AS daynight,
    CASE WHEN event_id % 2 = 0 THEN 'N' ELSE '1' END AS satellite
  FROM events),
numbers AS (
  SELECT * REPLACE (
    CASE WHEN isnan(TRY_CAST(trim(latitude) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(latitude) AS DOUBLE) END AS latitude,
    CASE WHEN isnan(TRY_CAST(trim(longitude) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(longitude) AS DOUBLE) END AS longitude,
    CASE WHEN isnan(TRY_CAST(trim(frp) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(frp) AS DOUBLE) END AS frp)
  FROM raw
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND acq_date IS NOT NULL
    AND acq_time IS NOT NULL AND frp IS NOT NULL),
valid AS (
  SELECT * FROM numbers
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND frp >= 0),
timed AS (
  SELECT *, TRY_STRPTIME(acq_date || ' ' || lpad(acq_time, 4, '0'), '%Y-%m-%d %H%M') AS acq_datetime_utc
  FROM valid
  WHERE TRY_STRPTIME(acq_date || ' ' || lpad(acq_time, 4, '0'), '%Y-%m-%d %H%M') IS NOT NULL)"""


def raw_weather(spark: SparkSession, sf_dir: str, entity: str = "type") -> DataFrame:
    """Daily weather snapshots: several per key, some without a stamp; day 17 is known only for a place without detections."""
    o = F.col("o_orderkey")
    name = (F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("o_custkey") % 5 + 1).cast("int"))
            if entity == "type" else (F.col("o_custkey") % 30).cast("string"))
    return table(spark, sf_dir, "orders").select(
        o.alias("snapshot_id"), F.when(o % 30 == 16, "elsewhere" if entity == "type" else "30").otherwise(name).alias("province_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (o % 30).cast("int")), "yyyy-MM-dd").alias("date"),
        F.when(o % 97 != 0, F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd")).alias("fetched_at_utc"),
        (F.lit(28.0) + (o * 7 % 80) / F.lit(10.0)).alias("temperature_2m_max"),
        (F.lit(20.0) + (o * 11 % 60) / F.lit(10.0)).alias("temperature_2m_min"),
        F.greatest(F.lit(0.0), F.col("o_totalprice") % F.lit(20.0) / F.lit(4.0) - F.lit(2.75)).alias("precipitation_sum"),
        ((o * 13 % 250) / F.lit(10.0)).alias("windspeed_10m_max"),
        (o * 17 % 360).cast("double").alias("winddirection_10m_dominant"),
        (F.lit(50.0) + (o * 19 % 500) / F.lit(10.0)).alias("relative_humidity_2m_mean"))


def weather_sql(entity: str = "type") -> str:
    name = ("list_extract(['click', 'error', 'purchase', 'signup', 'view'], CAST(o_custkey % 5 + 1 AS INTEGER))"
            if entity == "type" else "CAST(o_custkey % 30 AS VARCHAR)")
    gap = "elsewhere" if entity == "type" else "30"
    return f"""snapshots AS (
  SELECT o_orderkey AS snapshot_id, CASE WHEN o_orderkey % 30 = 16 THEN '{gap}' ELSE {name} END AS province_id,
    DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS date,
    CASE WHEN o_orderkey % 97 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS fetched_at_utc,
    CAST(28 AS DOUBLE) + (o_orderkey * 7 % 80) / CAST(10 AS DOUBLE) AS temperature_2m_max,
    CAST(20 AS DOUBLE) + (o_orderkey * 11 % 60) / CAST(10 AS DOUBLE) AS temperature_2m_min,
    greatest(CAST(0 AS DOUBLE), o_totalprice % CAST(20 AS DOUBLE) / CAST(4 AS DOUBLE) - CAST(2.75 AS DOUBLE)) AS precipitation_sum,
    (o_orderkey * 13 % 250) / CAST(10 AS DOUBLE) AS windspeed_10m_max,
    CAST(o_orderkey * 17 % 360 AS DOUBLE) AS winddirection_10m_dominant,
    CAST(50 AS DOUBLE) + (o_orderkey * 19 % 500) / CAST(10 AS DOUBLE) AS relative_humidity_2m_mean
  FROM orders),
weather AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY province_id, date
      ORDER BY fetched_at_utc DESC NULLS FIRST, snapshot_id DESC) AS rn FROM snapshots)
  WHERE rn = 1)"""


def log_of(events: DataFrame) -> DataFrame:
    """One row per request: time, endpoint, status code, duration and predicted value."""
    return events.withColumn("k", k_of()).withColumn("code", status_code()).select(
        F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"), "code", (F.col("value") / F.lit(50.0)).alias("duration_s"),
        F.when(F.col("code") == 200, F.col("value")).alias("prediction"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_of(table(spark, sf_dir, "events"))


LOG_SQL = """log AS (
  SELECT event_id AS request_id, ts, event_type AS endpoint,
    CASE CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 20 WHEN 0 THEN 503 WHEN 1 THEN 404
      WHEN 2 THEN 302 WHEN 3 THEN 102 ELSE 200 END AS code,
    value / CAST(50 AS DOUBLE) AS duration_s,
    CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 20 > 3 THEN value END AS prediction
  FROM events)"""


def area_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One overlapping box per supplier; every ninth box is degenerate."""
    s = F.col("s_suppkey")
    lat = F.lit(-5.5) + (s * 7 % 80) / F.lit(10.0)
    lon = F.lit(100.0) + (s * 13 % 150) / F.lit(10.0)
    return table(spark, sf_dir, "supplier").select(
        s.cast("int").alias("priority"), F.concat(F.lit("a"), s.cast("string")).alias("province_id"),
        F.when(s % 7 != 0, F.col("s_name")).alias("name"),
        lat.alias("lat_min"), lon.alias("lon_min"),
        (lat + F.when(s % 9 == 0, 0.0).otherwise(F.lit(0.5) + (s % 5) / F.lit(2.0))).alias("lat_max"),
        (lon + F.lit(1.0) + s % 4).alias("lon_max"))


AREA_SQL = """areas AS (
  SELECT *, lat_min + CASE WHEN priority % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) + (priority % 5) / CAST(2 AS DOUBLE) END AS lat_max,
    lon_min + CAST(1 AS DOUBLE) + priority % 4 AS lon_max
  FROM (
    SELECT CAST(s_suppkey AS INTEGER) AS priority, 'a' || s_suppkey AS province_id,
      CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS name,
      CAST(-5.5 AS DOUBLE) + (s_suppkey * 7 % 80) / CAST(10 AS DOUBLE) AS lat_min,
      CAST(100 AS DOUBLE) + (s_suppkey * 13 % 150) / CAST(10 AS DOUBLE) AS lon_min
    FROM supplier))"""
