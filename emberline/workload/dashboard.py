"""Dashboard, forecast and scoring-frame queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions import risk
from emberline.operators import daily as A
from emberline.operators import dashboard as B
from emberline.operators import scoring as P
from emberline.operators import windows as W
from emberline.session import new_folder
from emberline.workload import standins as D
from emberline.workload.features import DAILY_SQL, RISK_SQL, places_of, rounded
from emberline.workload.registry import query

RANK_SQL = "CASE confidence WHEN 'n' THEN 1 WHEN 'h' THEN 2 ELSE 0 END"


DASHBOARD_SQL = f"""WITH {D.RAW_SQL}
SELECT event_id, TRY_CAST(acq_date AS DATE) AS acq_date, lower({D.STRIPPED_SQL}) AS confidence,
  CASE WHEN isnan(TRY_CAST(trim(latitude) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(latitude) AS DOUBLE) END AS latitude,
  CASE WHEN isnan(TRY_CAST(trim(longitude) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(longitude) AS DOUBLE) END AS longitude,
  CASE WHEN isnan(TRY_CAST(trim(frp) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(frp) AS DOUBLE) END AS frp
FROM raw WHERE TRY_CAST(acq_date AS DATE) IS NOT NULL
  AND NOT isnan(TRY_CAST(trim(latitude) AS DOUBLE)) AND TRY_CAST(trim(longitude) AS DOUBLE) IS NOT NULL"""


@query("dashboard_scan", DASHBOARD_SQL)
def _(spark, sf):
    return B.prepare_hotspots(D.raw_detections(spark, sf)).select(
        "event_id", "acq_date", "confidence", "latitude", "longitude", "frp")


@query("hotspot_filter", f"""WITH {D.det_sql()}
SELECT event_id, province_id, acq_date, confidence FROM det
WHERE acq_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND province_id IN ('click', 'view') AND {RANK_SQL} >= 1""")
def _(spark, sf):
    return B.filter_hotspots(D.detections(spark, sf), "2024-01-05", "2024-01-20", ["click", "view"], "nominal").select(
        "event_id", "province_id", "acq_date", "confidence")


@query("confidence_rank", f"WITH {D.det_sql()} SELECT confidence, CAST({RANK_SQL} AS INTEGER) AS level, count(*) AS n FROM det GROUP BY ALL")
def _(spark, sf):
    ranked = D.detections(spark, sf).withColumn("level", risk.confidence_rank(F.col("confidence")))
    return ranked.groupBy("confidence", "level").agg(F.count(F.lit(1)).alias("n"))


@query("default_range", f"""WITH {D.det_sql()}
SELECT event_id, acq_date FROM det WHERE acq_date >= (SELECT greatest(min(acq_date), max(acq_date) - 7) FROM det)""")
def _(spark, sf):
    return B.in_default_range(D.detections(spark, sf), 7).select("event_id", "acq_date")


@query("daily_counts", f"WITH {D.det_sql('user')} SELECT acq_date, province_id, count(*) AS hotspot_count FROM det GROUP BY ALL")
def _(spark, sf):
    return A.count_daily(D.detections(spark, sf, "user"))


@query("daily_pivot", f"""WITH {D.det_sql()}
SELECT acq_date, {', '.join(f"count(*) FILTER (province_id = '{t}') AS {t}" for t in D.TYPES)} FROM det GROUP BY acq_date""")
def _(spark, sf):
    return B.pivot_daily(D.detections(spark, sf), D.TYPES)


@query("headline_numbers", f"""WITH {D.det_sql('user')}
SELECT count(*) AS n_hotspots, count(DISTINCT province_id) AS n_entities, round(avg(frp), 8) AS mean_frp, 30 AS n_days FROM det""")
def _(spark, sf):
    return rounded(B.headline_numbers(D.detections(spark, sf, "user"), "2024-01-01", "2024-01-30"))


@query("distinct_counts", f"""WITH {D.det_sql('user')}
SELECT count(DISTINCT province_id) AS n_entities, count(DISTINCT acq_date) AS n_dates, count(DISTINCT confidence) AS n_classes FROM det""")
def _(spark, sf):
    return D.detections(spark, sf, "user").agg(
        F.count_distinct("province_id").alias("n_entities"), F.count_distinct("acq_date").alias("n_dates"),
        F.count_distinct("confidence").alias("n_classes"))


# Days are merged from their stored sketches; the estimate lies within three standard errors of the exact count.
@query("distinct_sketches", f"""WITH {D.det_sql('user')}
SELECT date_trunc('month', acq_date)::DATE AS month, count(DISTINCT province_id) AS n_entities, count(DISTINCT event_id) AS n_events,
  true AS entities_near, true AS events_near FROM det GROUP BY ALL""")
def _(spark, sf):
    det, folder, month = D.detections(spark, sf, "user"), new_folder(spark, "sketches"), F.trunc("acq_date", "month")
    B.distinct_sketches(det, ["province_id", "event_id"]).write.parquet(folder)
    near = B.merged_distinct(spark.read.parquet(folder).withColumn("month", month), ["province_id", "event_id"], ["month"])
    exact = det.groupBy(month.alias("month")).agg(F.count_distinct("province_id").alias("n_entities"), F.count_distinct("event_id").alias("n_events"))
    off = 3 * 1.04 / 64
    return exact.join(near, "month").select(
        "month", "n_entities", "n_events", (F.abs(F.col("n_province_id") - F.col("n_entities")) <= F.col("n_entities") * off + 1).alias("entities_near"),
        (F.abs(F.col("n_event_id") - F.col("n_events")) <= F.col("n_events") * off + 1).alias("events_near"))


@query("distinct_entities", f"WITH {D.det_sql('user')} SELECT DISTINCT province_id FROM det")
def _(spark, sf):
    return B.distinct_entities(D.detections(spark, sf, "user"))


# Top-k feature: the map draws at most 5000 points.
@query("fixed_sample", f"WITH {D.det_sql()} SELECT event_id, frp FROM det ORDER BY md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')), event_id LIMIT 5000")
def _(spark, sf):
    return B.fixed_sample(D.detections(spark, sf)).select("event_id", "frp")


@query("map_markers", f"""WITH {D.det_sql()}, top AS (SELECT max(acq_date) AS newest FROM det)
SELECT event_id, CAST(newest - acq_date AS INTEGER) AS age_days,
  round(greatest(CAST(0.4 AS DOUBLE), 1 - (newest - acq_date) / CAST(30 AS DOUBLE)), 8) AS opacity,
  round(greatest(CAST(3 AS DOUBLE), least(CAST(12 AS DOUBLE), coalesce(nullif(frp, 0), 5) / 8)), 8) AS radius
FROM det, top""")
def _(spark, sf):
    return rounded(B.markers(D.detections(spark, sf)).select("event_id", "age_days", "opacity", "radius"))


# Persistence forecast: each entity's last count, less 2, with every fourth one failed.
def forecast(spark, sf, entity="user"):
    last = W.latest_per_entity(A.aggregate_daily(D.detections(spark, sf, entity)))
    failed = F.col("province_id").cast("int") % 4 == 0 if entity != "type" else F.lit(False)
    return last.withColumn("prediction", F.when(~failed, F.col("hotspot_count").cast("double") - 2))


FORECAST_SQL = f"""{DAILY_SQL},
forecast AS (SELECT province_id, date, hotspot_count,
    CASE WHEN CAST(province_id AS INTEGER) % 4 <> 0 THEN CAST(hotspot_count AS DOUBLE) - 2 END AS prediction
  FROM (SELECT *, row_number() OVER (PARTITION BY province_id ORDER BY date DESC) AS rn FROM daily) WHERE rn = 1)"""
LABEL_SQL = "CASE {c} WHEN 0 THEN 'Aman' WHEN 1 THEN 'Waspada' WHEN 2 THEN 'Bahaya' END"


@query("newest_day_table", f"""WITH {D.det_sql('user')}, {FORECAST_SQL}
SELECT f.province_id, f.prediction, count(d.event_id) AS today_count
FROM forecast f LEFT JOIN det d ON d.province_id = f.province_id AND d.acq_date = (SELECT max(acq_date) FROM det)
GROUP BY f.province_id, f.prediction""")
def _(spark, sf):
    return B.newest_day_table(D.detections(spark, sf, "user"), forecast(spark, sf).select("province_id", "prediction"))


@query("prediction_rows", f"""WITH {D.det_sql('user')}, {FORECAST_SQL},
leveled AS (SELECT *, CAST({RISK_SQL.format(c='prediction', none='NULL')} AS INTEGER) AS risk_level FROM forecast)
SELECT province_id, hotspot_count AS today_count, date AS date_today, prediction AS prediction_count, risk_level,
  {LABEL_SQL.format(c='risk_level')} AS risk_label FROM leveled""")
def _(spark, sf):
    return P.prediction_rows(forecast(spark, sf))


@query("risk_class", f"""WITH {D.det_sql('user')}, {DAILY_SQL},
leveled AS (SELECT province_id, date, hotspot_count - 3 AS shifted,
  CAST({RISK_SQL.format(c='(hotspot_count - 3)', none='NULL')} AS INTEGER) AS level FROM daily)
SELECT *, {LABEL_SQL.format(c='level')} AS label FROM leveled""")
def _(spark, sf):
    shifted = A.aggregate_daily(D.detections(spark, sf, "user")).select(
        "province_id", "date", (F.col("hotspot_count") - 3).alias("shifted"))
    leveled = shifted.withColumn("level", risk.risk_level(F.col("shifted")))
    return leveled.withColumn("label", risk.risk_label(F.col("level")))


@query("prediction_totals", f"""WITH {D.det_sql('user')}, {FORECAST_SQL}
SELECT CAST(coalesce(sum(hotspot_count), 0) AS BIGINT) AS total_today, coalesce(sum(prediction), 0) AS total_tomorrow
FROM forecast WHERE prediction IS NOT NULL""")
def _(spark, sf):
    return P.prediction_totals(P.prediction_rows(forecast(spark, sf)))


@query("attach_forecast", f"""WITH {D.det_sql('user')}, {FORECAST_SQL}
SELECT CAST(c.c_custkey AS VARCHAR) AS province_id,
  coalesce(CASE WHEN c.c_custkey % 7 <> 0 THEN c.c_name END, CAST(c.c_custkey AS VARCHAR)) AS name,
  f.prediction AS prediction_count, CAST({RISK_SQL.format(c='f.prediction', none='NULL')} AS INTEGER) AS risk_level
FROM customer c LEFT JOIN forecast f ON f.province_id = CAST(c.c_custkey AS VARCHAR)""")
def _(spark, sf):
    key = F.col("c_custkey")
    areas = D.table(spark, sf, "customer").select(
        key.cast("string").alias("province_id"), F.when(key % 7 != 0, F.col("c_name")).alias("name"))
    rows = P.prediction_rows(forecast(spark, sf)).select("province_id", "prediction_count", "risk_level")
    return P.attach_forecast(areas, rows)


@query("encoded_features", f"""WITH {D.det_sql('group')}, {DAILY_SQL}
SELECT province_id, date, {', '.join(
    f"CAST({c} AS BIGINT) AS {c}" if c in ('hotspot_count', 'n_daytime', 'n_nighttime', 'n_confidence_high') else
    f"CAST(0 AS BIGINT) AS {c}" if c in S.LONG_FEATURES else f"CAST(0 AS INTEGER) AS {c}" if c in S.INT_FEATURES else
    f"round(coalesce({c}, 0), {places_of(c, 8)}) AS {c}" if c in ('frp_mean', 'frp_max', 'frp_sum') else
    f"CAST(coalesce(lag(hotspot_count, 7) OVER (PARTITION BY province_id ORDER BY date), 0) AS DOUBLE) AS {c}"
    if c == 'hotspot_count_lag_7d' else f"CAST(0 AS DOUBLE) AS {c}" for c in S.FEATURES)}
FROM daily""")
def _(spark, sf):
    daily = W.add_lags(A.aggregate_daily(D.detections(spark, sf, "group")), (7,))
    return rounded(P.encode_features(daily, ["province_id", "date"]))


@query("serving_features", f"""WITH {D.det_sql('group')},
served AS (SELECT province_id, acq_date AS date, count(*) AS hotspot_count, coalesce(avg(frp), 0) AS frp_mean FROM det GROUP BY ALL)
SELECT province_id, date, hotspot_count, round(frp_mean, 10) AS frp_mean, CAST(month(date) AS INTEGER) AS month,
  CAST(32 AS DOUBLE) AS temperature_2m_max, CAST(24 AS DOUBLE) AS temperature_2m_min, CAST(0 AS DOUBLE) AS precipitation_sum,
  CAST(10 AS DOUBLE) AS windspeed_10m_max, CAST(180 AS DOUBLE) AS winddirection_10m_dominant,
  CAST(75 AS DOUBLE) AS relative_humidity_2m_mean, CAST(7 AS BIGINT) AS days_since_rain,
  CAST(sum(hotspot_count) OVER (PARTITION BY province_id ORDER BY date
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS hotspot_count_7d
FROM served""")
def _(spark, sf):
    served = W.add_serving_windows(W.serving_daily(D.detections(spark, sf, "group")))
    return rounded(P.serving_features(served, ["province_id", "date"]).select(
        "province_id", "date", "hotspot_count", "frp_mean", "month", *S.WEATHER, "days_since_rain", "hotspot_count_7d"))
