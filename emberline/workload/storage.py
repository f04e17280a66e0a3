"""File scans and sinks, over files that Spark writes from the test tables first."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import cleaning as C
from emberline.operators import daily as A
from emberline.operators import dashboard as B
from emberline.operators import spatial as X
from emberline.plans import retrain as T
from emberline.session import new_folder
from emberline.sinks import tables as K
from emberline.sources import files as R
from emberline.sources import payloads as Y
from emberline.sources import snapshots as Z
from emberline.workload import standins as D
from emberline.workload.areas import ASSIGNED_SQL
from emberline.workload.dashboard import DASHBOARD_SQL, FORECAST_SQL, LABEL_SQL, forecast
from emberline.workload.features import DAILY_SQL, RISK_SQL, rounded
from emberline.workload.gate import ALL_SQL, gate_sql, runs, versions
from emberline.workload.registry import query


def as_layout(df, columns):
    return df.select(*[F.col(c) if c in df.columns else F.lit("0").alias(c) for c in columns])


def landed_detections(spark, sf) -> str:
    """Raw detections as CSV: even ids in the near-real-time layout, odd ones in the archive's."""
    folder = new_folder(spark, "landed")
    raw = D.raw_detections(spark, sf).withColumn("version", F.col("event_id").cast("string"))
    for rest, name, columns in ((0, "nrt", S.NRT_COLUMNS), (1, "archive", S.ARCHIVE_COLUMNS)):
        side = raw.filter(F.col("event_id") % 2 == rest)
        as_layout(side, columns + [S.ENTITY]).write.partitionBy(S.ENTITY).option("header", True).mode("append").csv(
            f"{folder}/{name}")
    return folder


@query("detection_scan", f"""WITH {D.RAW_SQL}
SELECT event_id, province_id, trim(latitude) AS latitude, acq_date, acq_time, frp, event_id % 2 = 1 AS has_type FROM raw""")
def _(spark, sf):
    df = R.scan_detections(spark, f"{landed_detections(spark, sf)}/*")
    return df.select(F.col("version").cast("long").alias("event_id"), S.ENTITY, F.trim("latitude").alias("latitude"),
                     "acq_date", "acq_time", "frp", F.col("type").isNotNull().alias("has_type"))


@query("dashboard_file_scan", DASHBOARD_SQL)
def _(spark, sf):
    """The dashboard's rows from files of two layouts."""
    rows = B.prepare_hotspots(R.scan_detections(spark, f"{landed_detections(spark, sf)}/*"))
    return rows.select(F.col("version").cast("long").alias("event_id"), "acq_date", "confidence", "latitude", "longitude", "frp")


def landed_by_prefix(spark, sf) -> str:
    """Raw detections as one CSV file per area, which only the file's name tells: <area>_20240101_UTC.csv."""
    folder = new_folder(spark, "prefixed")
    raw = D.raw_detections(spark, sf).withColumn("version", F.col("event_id").cast("string"))
    named = as_layout(raw, S.NRT_COLUMNS + [S.ENTITY]).withColumn("file", F.concat(S.ENTITY, F.lit("_20240101_UTC"))).drop(S.ENTITY)
    named.repartition("file").write.partitionBy("file").option("header", True).csv(f"{folder}/parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{folder}/named"))
    for found in files.globStatus(path(f"{folder}/parts/file=*/part-*.csv")):
        part = found.getPath()
        files.rename(part, path(f"{folder}/named/{part.getParent().getName().removeprefix('file=')}.csv"))
    return f"{folder}/named"


@query("prefix_scan", f"""WITH {D.RAW_SQL}
SELECT event_id, province_id, trim(latitude) AS latitude, acq_date, frp FROM raw""")
def _(spark, sf):
    df = R.scan_detections(spark, landed_by_prefix(spark, sf))
    return df.select(F.col("version").cast("long").alias("event_id"), S.ENTITY, F.trim("latitude").alias("latitude"), "acq_date", "frp")


@query("csv_to_daily", f"""WITH {D.RAW_SQL},
one AS (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_datetime_utc, satellite ORDER BY event_id) AS rn FROM timed)
SELECT province_id, CAST(acq_datetime_utc + INTERVAL 7 HOUR AS DATE) AS date, count(*) AS hotspot_count, round(sum(frp), 6) AS frp_sum
FROM one WHERE rn = 1 GROUP BY ALL""")
def _(spark, sf):
    raw = R.scan_detections(spark, f"{landed_detections(spark, sf)}/*")
    clean = C.clean_detections(raw, [F.col("version").cast("long")])
    return rounded(A.aggregate_daily(clean).select(S.ENTITY, "date", "hotspot_count", "frp_sum"), 6)


@query("archive_scan", f"""WITH {D.RAW_SQL}
SELECT event_id, CASE WHEN isnan(TRY_CAST(trim(latitude) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(latitude) AS DOUBLE) END AS latitude,
  TRY_CAST(trim(longitude) AS DOUBLE) AS longitude FROM raw
WHERE NOT isnan(TRY_CAST(trim(latitude) AS DOUBLE)) AND TRY_CAST(trim(longitude) AS DOUBLE) IS NOT NULL""")
def _(spark, sf):
    folder = new_folder(spark, "archive")
    raw = D.raw_detections(spark, sf).withColumn("version", F.col("event_id").cast("string"))
    as_layout(raw, S.ARCHIVE_COLUMNS + [S.ENTITY]).write.partitionBy(S.ENTITY).option("header", True).csv(folder)
    df = R.scan_archive(spark, folder)
    return df.select(F.col("version").cast("long").alias("event_id"), "latitude", "longitude")


@query("header_contract", """SELECT event_type AS province_id, layout, layout <> 'broken' AS accepted,
  CASE layout WHEN 'broken' THEN 'acq_time,longitude' ELSE '' END AS missing_critical,
  CASE layout WHEN 'nrt' THEN '' WHEN 'archive' THEN 'bright_ti4,bright_ti5'
    ELSE 'acq_time,bright_ti4,bright_ti5,confidence,daynight,instrument,longitude,satellite,scan,track,version' END AS missing_extra
FROM (SELECT DISTINCT event_type FROM events), (VALUES ('nrt'), ('archive'), ('broken')) l(layout)""")
def _(spark, sf):
    folder = landed_detections(spark, sf)
    as_layout(D.raw_detections(spark, sf), ["latitude", "acq_date", "frp", S.ENTITY]).write.partitionBy(
        S.ENTITY).option("header", True).csv(f"{folder}/broken")
    found = None
    for layout in ("nrt", "archive", "broken"):
        part = R.header_contract(R.csv_headers(spark, f"{folder}/{layout}")).withColumn("layout", F.lit(layout))
        found = part if found is None else found.unionByName(part)
    return found.select(
        F.regexp_extract("file_path", "province_id=([^/]+)/", 1).alias("province_id"), "layout", "accepted",
        F.array_join("missing_critical", ",").alias("missing_critical"),
        F.array_join("missing_extra", ",").alias("missing_extra")).distinct()


# One file per area; in some areas every fiftieth line has a field too many, so the whole file is left out and listed.
@query("malformed_files", f"""WITH {D.RAW_SQL},
files AS (SELECT province_id, count(*) + 1 AS n_lines, count(*) FILTER (event_id % 50 = 0 AND province_id IN ('click', 'view')) > 0 AS wide
  FROM raw GROUP BY province_id)
SELECT province_id, n_lines, CASE WHEN wide THEN 'a line with too many fields' END AS reason, CASE WHEN wide THEN 0 ELSE n_lines - 1 END AS n_kept
FROM files""")
def _(spark, sf):
    folder, raw = new_folder(spark, "malformed"), D.raw_detections(spark, sf).withColumn("version", F.col("event_id").cast("string"))
    cells = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in S.NRT_COLUMNS])
    odd = F.when((F.col("event_id") % 50 == 0) & F.col(S.ENTITY).isin("click", "view"), ",9").otherwise("")
    lines = as_layout(raw, S.NRT_COLUMNS + [S.ENTITY, "event_id"]).select(S.ENTITY, F.lit(1).alias("at"), F.concat(cells, odd).alias("value"))
    heads = raw.select(S.ENTITY).distinct().select(S.ENTITY, F.lit(0).alias("at"), F.lit(",".join(S.NRT_COLUMNS)).alias("value"))
    named = lines.unionByName(heads).repartition(S.ENTITY).sortWithinPartitions(S.ENTITY, "at").select(S.ENTITY, "value")
    named.write.partitionBy(S.ENTITY).text(f"{folder}/text")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path(f"{folder}/text/*/part-*.txt")):
        files.rename(found.getPath(), path(str(found.getPath()).removesuffix(".txt") + ".csv"))
    area = F.regexp_extract("file_path", "province_id=([^/]+)/", 1)
    listed = R.csv_files(spark, f"{folder}/text").select(area.alias(S.ENTITY), "n_lines", "file_path")
    bad = R.quarantine(R.csv_files(spark, f"{folder}/text"), S.HEADER_CRITICAL).select("file_path", "reason")
    kept = R.scan_detections(spark, f"{folder}/text").groupBy(S.ENTITY).agg(F.count(F.lit(1)).alias("n_kept"))
    return (listed.join(bad, "file_path", "left").drop("file_path").join(kept, S.ENTITY, "left")
            .withColumn("n_kept", F.coalesce("n_kept", F.lit(0))))


@query("weather_scan", f"""WITH {D.weather_sql('group')}
SELECT snapshot_id, province_id, date, fetched_at_utc, precipitation_sum FROM weather""")
def _(spark, sf):
    folder = new_folder(spark, "weather")
    raw = D.raw_weather(spark, sf, "group")
    stamped = raw.filter(F.col("fetched_at_utc").isNotNull())
    stamped.write.option("header", True).csv(f"{folder}/a")
    raw.filter(F.col("fetched_at_utc").isNull()).drop("fetched_at_utc").write.option("header", True).csv(f"{folder}/b")
    df = R.scan_weather(spark, f"{folder}/*")
    return C.clean_weather(df, [F.desc(F.col("snapshot_id").cast("long"))]).select(
        F.col("snapshot_id").cast("long").alias("snapshot_id"), S.ENTITY, "date", "fetched_at_utc", "precipitation_sum")


# One payload per entity with its days in order; some payloads lack a variable.
@query("weather_payloads", f"""WITH {D.weather_sql('group')}
SELECT province_id, date, temperature_2m_max, CASE WHEN CAST(province_id AS INTEGER) % 3 <> 0 THEN windspeed_10m_max END AS windspeed_10m_max
FROM weather""")
def _(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf, "group"), [F.desc("snapshot_id")])
    days = F.sort_array(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), *S.WEATHER)))
    grouped = weather.groupBy(S.ENTITY).agg(days.alias("d"))
    variables = [F.when((F.col(S.ENTITY).cast("int") % 3 != 0) | F.lit(v != "windspeed_10m_max"), F.col(f"d.{v}")).alias(v)
                 for v in S.WEATHER]
    payload = F.to_json(F.struct(F.struct(F.col("d.date").alias("time"), *variables).alias("daily")))
    return Y.weather_rows(grouped.select(S.ENTITY, payload.alias("payload"))).select(
        S.ENTITY, "date", "temperature_2m_max", "windspeed_10m_max")


def snapshots(spark, sf) -> str:
    """Two production snapshots and a newer scenario one; the first has fewer columns."""
    path = new_folder(spark, "features")
    daily = A.aggregate_daily(D.detections(spark, sf))
    K.write_snapshot(daily.select(S.ENTITY, "date", "hotspot_count"), path, now=datetime(2024, 2, 1))
    K.write_snapshot(daily.select(S.ENTITY, "date", "hotspot_count", "frp_max"), path, now=datetime(2024, 2, 2))
    shifted = daily.select(S.ENTITY, "date", (F.col("hotspot_count") * 2).alias("hotspot_count"), "frp_max")
    K.write_snapshot(shifted, path, kind="drought", now=datetime(2024, 2, 3))
    return path


@query("all_snapshots", f"""WITH {D.det_sql()}, {DAILY_SQL}
SELECT province_id, date, hotspot_count * f AS hotspot_count, CASE WHEN s > 1 THEN frp_max END AS frp_max, kind,
  '2024020' || s || '_000000_000000' AS snapshot_ts
FROM daily, (VALUES (1, 'prod', 1), (2, 'prod', 1), (3, 'drought', 2)) v(s, kind, f)""")
def _(spark, sf):
    return Z.read_snapshots(spark, snapshots(spark, sf)).withColumn("snapshot_ts", F.col("snapshot_ts").cast("string"))


@query("latest_snapshot", f"WITH {D.det_sql()}, {DAILY_SQL} SELECT province_id, date, hotspot_count, frp_max FROM daily")
def _(spark, sf):
    return Z.latest_snapshot(spark, snapshots(spark, sf))


@query("scenario_snapshot", f"WITH {D.det_sql()}, {DAILY_SQL} SELECT province_id, date, hotspot_count * 2 AS hotspot_count, frp_max FROM daily")
def _(spark, sf):
    return Z.latest_snapshot(spark, snapshots(spark, sf), "drought")


@query("split_files", f"""WITH {D.det_sql()}, {D.AREA_SQL},
boxes AS (SELECT province_id AS area, * EXCLUDE (province_id) FROM areas), {ASSIGNED_SQL}
SELECT area AS province_id, event_id, acq_date FROM assigned WHERE area IS NOT NULL""")
def _(spark, sf):
    areas, folder = D.area_table(spark, sf), new_folder(spark, "split")
    det = X.assign_many(D.detections(spark, sf), areas).select("event_id", S.ENTITY, "acq_date", "latitude", "longitude")
    K.write_split(det, areas, folder)
    back = spark.read.option("header", True).schema("event_id long, acq_date date, latitude double, longitude double, province_id string").csv(folder)
    return back.select(S.ENTITY, "event_id", "acq_date")


@query("prediction_files", f"""WITH {D.det_sql('user')}, {FORECAST_SQL},
leveled AS (SELECT *, CAST({RISK_SQL.format(c='prediction', none='NULL')} AS INTEGER) AS risk_level FROM forecast)
SELECT province_id, hotspot_count AS today_count, date AS date_today, prediction AS prediction_count, risk_level,
  {LABEL_SQL.format(c='risk_level')} AS risk_label FROM leveled""")
def _(spark, sf):
    from emberline.operators.scoring import prediction_rows
    rows, folder = prediction_rows(forecast(spark, sf)), new_folder(spark, "predictions")
    K.write_predictions(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


@query("gate_report_files", gate_sql(12.0, 8.0, 0.78, 0.85))
def _(spark, sf):
    report, folder = T.gate_report(runs(spark, sf), required=()), new_folder(spark, "gate")
    K.append_report(report, folder)
    back = spark.read.schema(report.schema).json(folder)
    return back.select("run_id", F.array_join("failed_checks", "; ").alias("failed_checks"), "passed")


@query("round_report_files", f"""WITH {ALL_SQL}
SELECT model, new_run_id, decision, 'manual' AS reason, CAST(4 AS INTEGER) AS n_stages, decision AS last_stage,
  coalesce(printf('rmse=%.4f', new_metric), 'no metric') AS first_detail, decision <> 'abort' AS decided FROM decided""")
def _(spark, sf):
    decisions = T.decide_round(runs(spark, sf), versions(spark, sf))
    report = T.round_report(decisions, F.lit("2024-06-01T00:00:00"), F.lit("manual"))
    folder = new_folder(spark, "rounds")
    K.append_report(report, folder)
    back = spark.read.schema(report.schema).json(folder)
    return back.select("model", "new_run_id", "decision", "reason", F.size("stages").alias("n_stages"),
                       F.col("stages")[0]["detail"].alias("first_detail"), F.col("stages")[2]["ok"].alias("decided"), F.col("stages")[3]["name"].alias("last_stage"))


@query("union_by_name", f"""WITH {D.RAW_SQL}
SELECT event_id, province_id, CASE WHEN event_id % 2 = 0 THEN frp END AS frp, CASE WHEN event_id % 2 = 1 THEN acq_date END AS acq_date FROM raw""")
def _(spark, sf):
    raw = D.raw_detections(spark, sf)
    left = raw.filter(F.col("event_id") % 2 == 0).select("event_id", "province_id", "frp")
    right = raw.filter(F.col("event_id") % 2 == 1).select("acq_date", "province_id", "event_id")
    return left.unionByName(right, allowMissingColumns=True)
