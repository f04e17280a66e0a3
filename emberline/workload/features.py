"""Daily aggregation, training and serving feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import cleaning as C
from emberline.operators import daily as A
from emberline.operators import targets as T
from emberline.operators import windows as W
from emberline.plans import features as P
from emberline.workload import standins as D
from emberline.workload.registry import query


def places_of(column: str, places: int) -> int:
    """Daily means have up to nine decimals for a count that is a multiple of 128, and sums are
    large: each is rounded where neither a tie nor summation order can show."""
    return 10 if column.startswith("frp_mean") else 6 if column == "frp_sum" else places


def rounded(df, places: int = 8):
    """Doubles rounded on both sides: summation order differs between engines."""
    return df.select(*[F.round(c, places_of(c, places)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


DAILY_SQL = """daily AS (
  SELECT province_id, acq_date_wib AS date, count(*) AS hotspot_count, avg(frp) AS frp_mean, max(frp) AS frp_max,
    coalesce(sum(frp), 0) AS frp_sum,
    CAST(count(*) FILTER (upper(daynight) = 'D') AS BIGINT) AS n_daytime,
    CAST(count(*) FILTER (upper(daynight) = 'N') AS BIGINT) AS n_nighttime,
    CAST(count(*) FILTER (lower(confidence) = 'h') AS BIGINT) AS n_confidence_high
  FROM det GROUP BY province_id, acq_date_wib)"""

ROLL_SQL = ", ".join(
    f"CAST(sum(hotspot_count) OVER (PARTITION BY province_id ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    f" AS DOUBLE) AS hotspot_count_{w}d, "
    f"avg(frp_mean) OVER (PARTITION BY province_id ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    f" AS frp_mean_{w}d" for w in S.WINDOWS)
LAG_SQL = ", ".join(
    f"CAST(lag(hotspot_count, {n}) OVER (PARTITION BY province_id ORDER BY date) AS DOUBLE) AS hotspot_count_lag_{n}d"
    for n in S.WINDOWS)

# Islands form of days since rain: number rows inside each stretch that starts with rain.
RAIN_SQL = """flagged AS (
  SELECT *, sum(CASE WHEN precipitation_sum >= 1.0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY province_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS seg FROM joined),
rain AS (
  SELECT * EXCLUDE (seg), CASE WHEN seg = 0 THEN CAST(0 AS BIGINT)
    ELSE row_number() OVER (PARTITION BY province_id, seg ORDER BY date) - 1 END AS days_since_rain FROM flagged)"""

JOINED_SQL = f"""joined AS (
  SELECT d.*, {', '.join('w.' + c for c in S.WEATHER)}
  FROM daily d LEFT JOIN weather w ON d.province_id = w.province_id AND d.date = w.date)"""

CALENDAR_SQL = """CAST(month(date) AS INTEGER) AS month, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  sin(2 * pi() * month(date) / 12) AS month_sin, cos(2 * pi() * month(date) / 12) AS month_cos"""

LABELLED_SQL = """labelled AS (
  SELECT *, CAST(lead(hotspot_count) OVER (PARTITION BY province_id ORDER BY date) AS DOUBLE) AS hotspot_count_tomorrow
  FROM {source})"""

RISK_SQL = """CASE WHEN {c} IS NULL THEN {none} WHEN {c} <= 0 THEN 0 WHEN {c} <= 10 THEN 1 ELSE 2 END"""


def round_sql(columns, places: int = 8) -> str:
    return ", ".join(f"round({c}, {places_of(c, places)}) AS {c}" for c in columns)


DOUBLES = [c for c in S.FEATURES if c not in S.INT_FEATURES | S.LONG_FEATURES]

FEATURE_CTES = f"""{DAILY_SQL}, {JOINED_SQL}, {RAIN_SQL},
features AS (SELECT *, {CALENDAR_SQL}, {ROLL_SQL}, {LAG_SQL} FROM rain)"""


@query("daily_aggregate", f"""WITH {D.det_sql()}, {DAILY_SQL}
SELECT * REPLACE ({round_sql(['frp_mean', 'frp_max', 'frp_sum'])}) FROM daily""")
def _(spark, sf):
    return rounded(A.aggregate_daily(D.detections(spark, sf)))


@query("day_night_counts", f"""WITH {D.RAW_SQL}
SELECT province_id, acq_date AS date, CAST(sum(CASE WHEN upper(daynight) = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS n_daytime,
  CAST(sum(CASE WHEN upper(daynight) = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_nighttime
FROM valid WHERE acq_date <> '2024-13-01' GROUP BY province_id, acq_date""")
def _(spark, sf):
    raw = C.coerce_numbers(C.drop_incomplete(D.raw_detections(spark, sf), S.DETECTION_REQUIRED),
                           ["latitude", "longitude", "frp"])
    dated = C.in_domain(raw).withColumn("acq_date", F.col("acq_date").try_cast("date"))
    return A.aggregate_daily(dated, date="acq_date").select(
        "province_id", F.col("date").cast("string").alias("date"), "n_daytime", "n_nighttime")


@query("high_confidence_count", f"""WITH {D.RAW_SQL}
SELECT province_id, CAST(count(*) FILTER (lower({D.STRIPPED_SQL}) = 'h') AS BIGINT) AS n_confidence_high,
  count(*) AS hotspot_count
FROM timed GROUP BY province_id""")
def _(spark, sf):
    out = A.aggregate_daily(C.clean_detections(D.landed_raw(spark, sf), [F.col("event_id")]))
    return out.groupBy("province_id").agg(F.sum("n_confidence_high").alias("n_confidence_high"),
                                          F.sum("hotspot_count").alias("hotspot_count"))


@query("weather_per_day", f"""WITH {D.det_sql()}, {D.weather_sql()},
each AS (SELECT d.province_id, d.acq_date_wib AS date, {', '.join('w.' + c for c in S.WEATHER)}
  FROM det d LEFT JOIN weather w ON d.province_id = w.province_id AND d.acq_date_wib = w.date)
SELECT province_id, date, {', '.join(f'any_value({c}) AS {c}' for c in S.WEATHER)} FROM each GROUP BY province_id, date""")
def _(spark, sf):
    from emberline.operators.enrich import join_weather
    weather = C.clean_weather(D.raw_weather(spark, sf), [F.desc("snapshot_id")])
    joined = join_weather(D.detections(spark, sf), weather)
    return A.aggregate_daily(joined).select("province_id", "date", *S.WEATHER)


@query("daily_weather_join", f"""WITH {D.det_sql()}, {D.weather_sql()}, {DAILY_SQL}, {JOINED_SQL}
SELECT province_id, date, hotspot_count, {', '.join(S.WEATHER)} FROM joined""")
def _(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf), [F.desc("snapshot_id")])
    return A.join_daily_weather(A.aggregate_daily(D.detections(spark, sf)), weather).select(
        "province_id", "date", "hotspot_count", *S.WEATHER)


@query("calendar_features", f"""WITH {D.det_sql()}, {DAILY_SQL}
SELECT * REPLACE ({round_sql(['month_sin', 'month_cos'])}) FROM (SELECT province_id, date, {CALENDAR_SQL} FROM daily)""")
def _(spark, sf):
    return rounded(W.add_calendar(A.aggregate_daily(D.detections(spark, sf))).select(
        "province_id", "date", "month", "day_of_year", "month_sin", "month_cos"))


@query("rolling_rows", f"""WITH {D.det_sql('user')}, {DAILY_SQL}
SELECT * REPLACE ({round_sql([f'frp_mean_{w}d' for w in S.WINDOWS])}) FROM (
  SELECT province_id, date, {ROLL_SQL} FROM daily)""")
def _(spark, sf):
    names = [f"{c}_{w}d" for c in ("hotspot_count", "frp_mean") for w in S.WINDOWS]
    return rounded(W.add_rolling(A.aggregate_daily(D.detections(spark, sf, "user"))).select(
        "province_id", "date", *names))


@query("lag_rows", f"""WITH {D.det_sql('user')}, {DAILY_SQL} SELECT province_id, date, {LAG_SQL} FROM daily""")
def _(spark, sf):
    return W.add_lags(A.aggregate_daily(D.detections(spark, sf, "user"))).select(
        "province_id", "date", *[f"hotspot_count_lag_{n}d" for n in S.WINDOWS])


@query("days_since_rain", f"""WITH {D.det_sql('group')}, {D.weather_sql('group')}, {DAILY_SQL}, {JOINED_SQL}, {RAIN_SQL}
SELECT province_id, date, precipitation_sum, days_since_rain FROM rain""")
def _(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf, "group"), [F.desc("snapshot_id")])
    daily = A.join_daily_weather(A.aggregate_daily(D.detections(spark, sf, "group")), weather)
    return W.add_days_since_rain(daily).select("province_id", "date", "precipitation_sum", "days_since_rain")


@query("next_day_target", f"""WITH {D.det_sql('group')}, {DAILY_SQL}, {LABELLED_SQL.format(source='daily')}
SELECT province_id, date, hotspot_count_tomorrow, CAST({RISK_SQL.format(c='hotspot_count_tomorrow', none='-1')} AS INTEGER) AS risk_level
FROM labelled""")
def _(spark, sf):
    return T.add_targets(A.aggregate_daily(D.detections(spark, sf, "group"))).select(
        "province_id", "date", S.TARGET_COUNT, S.TARGET_CLASS)


@query("drop_unlabelled", f"""WITH {D.det_sql('user')}, {DAILY_SQL}, {LABELLED_SQL.format(source='daily')}
SELECT province_id, date, hotspot_count_tomorrow FROM labelled WHERE hotspot_count_tomorrow IS NOT NULL""")
def _(spark, sf):
    return T.drop_unlabelled(T.add_targets(A.aggregate_daily(D.detections(spark, sf, "user")))).select(
        "province_id", "date", S.TARGET_COUNT)


@query("dense_calendar", f"""WITH {D.det_sql('user')}, {DAILY_SQL},
span AS (SELECT province_id, unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date
  FROM daily GROUP BY province_id),
full_days AS (SELECT s.province_id, s.date, coalesce(d.hotspot_count, 0) AS hotspot_count, d.frp_mean,
  coalesce(d.frp_sum, 0) AS frp_sum FROM span s LEFT JOIN daily d USING (province_id, date))
SELECT province_id, date, hotspot_count, round(frp_mean, 10) AS frp_mean, round(frp_sum, 6) AS frp_sum,
  CAST(lag(hotspot_count) OVER (PARTITION BY province_id ORDER BY date) AS DOUBLE) AS hotspot_count_lag_1d
FROM full_days""")
def _(spark, sf):
    dense = A.fill_calendar(A.aggregate_daily(D.detections(spark, sf, "user")))
    return rounded(W.add_lags(dense, (1,)).select(
        "province_id", "date", "hotspot_count", "frp_mean", "frp_sum", "hotspot_count_lag_1d"))


@query("scoring_features", f"""WITH {D.det_sql('group')}, {D.weather_sql('group')}, {FEATURE_CTES}
SELECT province_id, date, {', '.join(c for c in S.FEATURES if c not in DOUBLES)}, {round_sql(DOUBLES)} FROM features""")
def _(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf, "group"), [F.desc("snapshot_id")])
    return rounded(P.daily_features(D.detections(spark, sf, "group"), weather).select("province_id", "date", *S.FEATURES))


@query("training_table", f"""WITH {D.det_sql()}, {D.DUP_SQL}, {D.weather_sql()},
one AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_datetime_utc, satellite
    ORDER BY priority, event_id) AS rn FROM dup) WHERE rn = 1),
{FEATURE_CTES.replace('FROM det ', 'FROM one ')}, {LABELLED_SQL.format(source='features')}
SELECT province_id, date, {', '.join(c for c in S.FEATURES if c not in DOUBLES)}, {round_sql(DOUBLES)},
  hotspot_count_tomorrow, CAST({RISK_SQL.format(c='hotspot_count_tomorrow', none='-1')} AS INTEGER) AS risk_level
FROM labelled WHERE hotspot_count_tomorrow IS NOT NULL""")
def training_table(spark, sf):
    dup = D.with_duplicates(D.detections(spark, sf))
    one = C.dedup_detections(dup, [F.col("priority"), F.col("event_id")])
    weather = C.clean_weather(D.raw_weather(spark, sf), [F.desc("snapshot_id")])
    return rounded(P.training_table(one, weather).select(
        "province_id", "date", *S.FEATURES, S.TARGET_COUNT, S.TARGET_CLASS))


@query("latest_row_per_entity", f"""WITH {D.det_sql('user')}, {DAILY_SQL}
SELECT province_id, date, hotspot_count, round(frp_mean, 10) AS frp_mean FROM (
  SELECT *, row_number() OVER (PARTITION BY province_id ORDER BY date DESC) AS rn FROM daily) WHERE rn = 1""")
def _(spark, sf):
    return rounded(W.latest_per_entity(A.aggregate_daily(D.detections(spark, sf, "user"))).select(
        "province_id", "date", "hotspot_count", "frp_mean"))


SERVING_SQL = """served AS (
  SELECT province_id, acq_date AS date, count(*) AS hotspot_count, coalesce(avg(frp), 0) AS frp_mean,
    coalesce(sum(frp), 0) AS frp_sum, count(frp) AS frp_n
  FROM det GROUP BY province_id, acq_date)"""


def _frame(expr: str, low: int, high: int) -> str:
    return (f"{expr} OVER (PARTITION BY province_id ORDER BY date "
            f"RANGE BETWEEN INTERVAL {low} DAY PRECEDING AND INTERVAL {high} DAY PRECEDING)")


@query("serving_rolling_count", f"""WITH {D.det_sql('user')}, {SERVING_SQL}
SELECT province_id, date, {', '.join(f"CAST({_frame('sum(hotspot_count)', d - 1, 0)} AS DOUBLE) AS hotspot_count_{d}d" for d in S.WINDOWS)}
FROM served""")
def _(spark, sf):
    served = W.serving_daily(D.detections(spark, sf, "user"))
    return W.add_serving_windows(served).select("province_id", "date", *[f"hotspot_count_{d}d" for d in S.WINDOWS])


# Straight from the detections, not from daily rows.
@query("serving_frp_mean", f"""WITH {D.det_sql('user')}, days AS (SELECT DISTINCT province_id, acq_date FROM det)
SELECT a.province_id, a.acq_date AS date,
  {', '.join(f"round(coalesce(avg(b.frp) FILTER (b.acq_date > a.acq_date - {d}), 0), 10) AS frp_mean_{d}d" for d in S.WINDOWS)}
FROM days a JOIN det b ON a.province_id = b.province_id AND b.acq_date <= a.acq_date AND b.acq_date > a.acq_date - 7
GROUP BY a.province_id, a.acq_date""")
def _(spark, sf):
    served = W.serving_daily(D.detections(spark, sf, "user"))
    return rounded(W.add_serving_windows(served).select("province_id", "date", *[f"frp_mean_{d}d" for d in S.WINDOWS]))


@query("serving_exact_lag", f"""WITH {D.det_sql('user')}, {SERVING_SQL}
SELECT s.province_id, s.date, {', '.join(f"CAST(coalesce(l{d}.hotspot_count, 0) AS DOUBLE) AS hotspot_count_lag_{d}d" for d in S.WINDOWS)}
FROM served s {' '.join(f"LEFT JOIN served l{d} ON l{d}.province_id = s.province_id AND l{d}.date = s.date - {d}" for d in S.WINDOWS)}""")
def _(spark, sf):
    served = W.serving_daily(D.detections(spark, sf, "user"))
    return W.add_serving_windows(served).select("province_id", "date", *[f"hotspot_count_lag_{d}d" for d in S.WINDOWS])


@query("recent_history", f"""WITH {D.det_sql()}
SELECT event_id, province_id, acq_date, frp FROM det WHERE acq_date >= (SELECT max(acq_date) FROM det) - 8""")
def _(spark, sf):
    return W.last_days(D.detections(spark, sf)).select("event_id", "province_id", "acq_date", "frp")
