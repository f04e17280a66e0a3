"""Request, alert and drift monitoring queries over the request log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.risk import status_class
from emberline.operators import alerts as L
from emberline.operators import daily as A
from emberline.operators import drift as G
from emberline.operators import metrics as M
from emberline.operators import requests as R
from emberline.operators import windows as W
from emberline.session import new_folder
from emberline.workload import standins as D
from emberline.workload.features import DAILY_SQL, rounded
from emberline.workload.registry import query

STATUS_SQL = """CASE WHEN code BETWEEN 200 AND 299 THEN '2xx' WHEN code BETWEEN 300 AND 399 THEN '3xx'
  WHEN code BETWEEN 400 AND 499 THEN '4xx' WHEN code BETWEEN 500 AND 599 THEN '5xx' ELSE 'other' END"""
LOG = f"{D.LOG_SQL}, slog AS (SELECT *, {STATUS_SQL} AS status FROM log)"


def log(spark, sf):
    return R.add_status(D.request_log(spark, sf))


def ended(df):
    return df.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def slides(minutes: int = 5) -> str:
    """Each log row once per minute-aligned window of the given length that holds it."""
    return f"""slid AS (SELECT l.*, date_trunc('minute', ts) + (INTERVAL 1 MINUTE) * i AS window_end
  FROM slog l, range(1, {minutes + 1}) r(i))"""


def bounds_sql(bounds) -> str:
    values = ", ".join(f"({i}, CAST({b} AS DOUBLE), CAST({bounds[i - 1] if i else 0} AS DOUBLE))" for i, b in enumerate(bounds))
    return f"bounds(i, le, low) AS (VALUES {values})"


def quantile_ctes(value: str, bounds, q: float, out: str = "quant") -> str:
    """Bucket quantile in long form: one row per window and bound, then the first bound reached."""
    last = bounds[-1]
    return f"""{bounds_sql(bounds)},
totals AS (SELECT window_end, count({value}) AS total FROM slid GROUP BY window_end),
cums AS (SELECT t.window_end, b.i, b.le, b.low, t.total, count(s.{value}) FILTER (s.{value} <= b.le) AS cum
  FROM totals t JOIN bounds b ON true JOIN slid s ON s.window_end = t.window_end GROUP BY ALL),
prev AS (SELECT *, coalesce(lag(cum) OVER (PARTITION BY window_end ORDER BY i), 0) AS below FROM cums),
hit AS (SELECT window_end, arg_min(CASE WHEN i = 0 AND le <= 0 THEN le ELSE
    low + (le - low) * ((CAST({q} AS DOUBLE) * total - below) / (cum - below)) END, i) AS v
  FROM prev WHERE total > 0 AND cum >= CAST({q} AS DOUBLE) * total GROUP BY window_end),
{out} AS (SELECT t.window_end, CASE WHEN t.total = 0 THEN NULL ELSE coalesce(h.v, CAST({last} AS DOUBLE)) END AS value
  FROM totals t LEFT JOIN hit h USING (window_end))"""


@query("status_class", f"WITH {LOG} SELECT code, status, count(*) AS n FROM slog GROUP BY ALL")
def _(spark, sf):
    return (D.request_log(spark, sf).groupBy("code", status_class(F.col("code")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("request_rate", f"""WITH {LOG}
SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, status, count(*) AS n, round(count(*) / 60.0, 8) AS per_second
FROM slog GROUP BY ALL""")
def _(spark, sf):
    return rounded(ended(R.request_rate(log(spark, sf))))


@query("error_rate", f"""WITH {LOG}, {slides()}
SELECT window_end, endpoint, count(*) FILTER (status IN ('4xx', '5xx')) AS n_errors, count(*) AS n,
  round(count(*) FILTER (status IN ('4xx', '5xx')) / greatest(CAST(count(*) AS DOUBLE), 1e-9), 8) AS error_rate
FROM slid GROUP BY ALL""")
def _(spark, sf):
    return rounded(ended(R.error_rate(log(spark, sf), by=["endpoint"])))


@query("duration_histogram", f"""WITH {LOG}, {slides(1)}, {bounds_sql([*S.DURATION_BOUNDS])},
every_bound AS (SELECT le FROM bounds UNION ALL SELECT CAST('Infinity' AS DOUBLE))
SELECT s.window_end, s.endpoint, b.le, count(*) FILTER (s.duration_s <= b.le) AS n FROM slid s, every_bound b GROUP BY ALL""")
def _(spark, sf):
    hist = R.sliding_histogram(log(spark, sf), "duration_s", S.DURATION_BOUNDS, 1, ["endpoint"])
    return ended(R.histogram_rows(hist, S.DURATION_BOUNDS, ["endpoint"]))


@query("duration_quantiles", f"""WITH {LOG}, {slides()}, {quantile_ctes('duration_s', S.DURATION_BOUNDS, 0.95)}
SELECT window_end, round(value, 8) AS p95 FROM quant""")
def _(spark, sf):
    hist = R.sliding_histogram(log(spark, sf), "duration_s", S.DURATION_BOUNDS)
    return rounded(ended(R.window_quantiles(hist, S.DURATION_BOUNDS, {"p95": 0.95})))


@query("prediction_quantiles", f"""WITH {LOG}, {slides()}, {quantile_ctes('prediction', S.PREDICTION_BOUNDS, 0.5)}
SELECT window_end, round(value, 8) AS p50 FROM quant""")
def _(spark, sf):
    hist = R.sliding_histogram(log(spark, sf), "prediction", S.PREDICTION_BOUNDS)
    return rounded(ended(R.window_quantiles(hist, S.PREDICTION_BOUNDS, {"p50": 0.5})))


@query("prediction_heatmap", f"""WITH {LOG}, {bounds_sql(S.PREDICTION_BOUNDS)}
SELECT time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
  (SELECT coalesce(min(le), CAST('Infinity' AS DOUBLE)) FROM bounds WHERE le >= prediction) AS le, count(*) AS n
FROM slog WHERE prediction IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return ended(R.prediction_heatmap(log(spark, sf)))


@query("compare_one_hour_earlier", f"""WITH {LOG}, {slides()}, {quantile_ctes('prediction', S.PREDICTION_BOUNDS, 0.95)}
SELECT a.window_end, round(a.value, 8) AS now, round(b.value, 8) AS base,
  round(a.value / CASE WHEN b.value IS NOT NULL THEN greatest(b.value, 0.1) END, 8) AS ratio
FROM quant a JOIN quant b ON a.window_end = b.window_end + INTERVAL 1 HOUR""")
def _(spark, sf):
    hist = R.sliding_histogram(log(spark, sf), "prediction", S.PREDICTION_BOUNDS)
    p = R.window_quantiles(hist, S.PREDICTION_BOUNDS, {"value": 0.95})
    return rounded(ended(R.compare_with_earlier(p, "value")))


SUSTAINED_SQL = """flags AS (SELECT window_end, coalesce({cond}, false) AS holds FROM {source})
SELECT window_end, holds, sum(CAST(holds AS INTEGER)) OVER (ORDER BY window_end
  RANGE BETWEEN INTERVAL {m} MINUTE PRECEDING AND CURRENT ROW) = {m} + 1 AS firing FROM flags"""


@query("latency_alert", f"""WITH {LOG}, {slides()}, {quantile_ctes('duration_s', S.DURATION_BOUNDS, 0.95)},
{SUSTAINED_SQL.format(cond='value > 1.0', source='quant', m=5)}""")
def _(spark, sf):
    return ended(R.latency_alert(log(spark, sf)))


@query("drift_alert", f"""WITH {LOG}, {slides()}, {quantile_ctes('prediction', S.PREDICTION_BOUNDS, 0.95)},
ratios AS (SELECT a.window_end, a.value / CASE WHEN b.value IS NOT NULL THEN greatest(b.value, 0.1) END AS ratio
  FROM quant a JOIN quant b ON a.window_end = b.window_end + INTERVAL 1 HOUR),
{SUSTAINED_SQL.format(cond='ratio > 1.5', source='ratios', m=10)}""")
def _(spark, sf):
    return ended(R.drift_alert(log(spark, sf)))


@query("active_requests", f"""WITH {LOG},
moves AS (SELECT ts AS moved, 1 AS delta FROM slog
  UNION ALL SELECT make_timestamp(epoch_us(ts) + CAST(round(duration_s * 1000000) AS BIGINT)), -1 FROM slog),
steps AS (SELECT time_bucket(INTERVAL 15 SECOND, moved) + INTERVAL 15 SECOND AS step_end, sum(delta) AS d FROM moves GROUP BY ALL)
SELECT step_end, CAST(sum(d) OVER (ORDER BY step_end ROWS UNBOUNDED PRECEDING) AS BIGINT) AS active FROM steps""")
def _(spark, sf):
    return R.active_requests(log(spark, sf)).withColumn("step_end", F.col("step_end").cast("timestamp_ntz"))


@query("load_summary", f"""WITH {LOG},
ok AS (SELECT endpoint, duration_s * 1000 AS ms, row_number() OVER (PARTITION BY endpoint ORDER BY duration_s) AS r,
  count(*) OVER (PARTITION BY endpoint) AS n FROM slog WHERE code = 200),
okp AS (SELECT endpoint, prediction, row_number() OVER (PARTITION BY endpoint ORDER BY prediction) AS r,
  count(*) OVER (PARTITION BY endpoint) AS n FROM slog WHERE code = 200 AND prediction IS NOT NULL),
ms AS (SELECT endpoint, round(max(ms) FILTER (r = least(floor(0.50 * n), n - 1) + 1), 6) AS p50_ms,
  round(max(ms) FILTER (r = least(floor(0.95 * n), n - 1) + 1), 6) AS p95_ms,
  round(max(ms) FILTER (r = least(floor(0.99 * n), n - 1) + 1), 6) AS p99_ms,
  round(min(ms), 6) AS min_ms, round(max(ms), 6) AS max_ms FROM ok GROUP BY endpoint),
pr AS (SELECT endpoint, count(*) AS n_predictions, min(prediction) AS prediction_min,
  max(prediction) FILTER (r = n // 2 + 1) AS prediction_median, max(prediction) AS prediction_max FROM okp GROUP BY endpoint),
t AS (SELECT endpoint, count(*) AS n_total, count(*) FILTER (code = 200) AS n_ok, count(*) FILTER (code <> 200) AS n_failed,
  round(count(*) FILTER (code = 200) * CAST(100 AS DOUBLE) / count(*), 8) AS success_pct,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE)), 8) AS throughput FROM slog GROUP BY endpoint)
SELECT * FROM t JOIN ms USING (endpoint) JOIN pr USING (endpoint)""")
def _(spark, sf):
    results = D.request_log(spark, sf).withColumn("elapsed_ms", F.col("duration_s") * 1000)
    elapsed = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(1e6)
    out = R.load_summary(results, elapsed, ["endpoint"])
    return out.select(*[F.round(c, 6).alias(c) if c.endswith("_ms") else F.round(c, 8).alias(c)
                        if c in ("success_pct", "throughput") else F.col(c) for c in out.columns])


@query("nearest_ranks", f"""WITH {LOG},
r AS (SELECT endpoint, duration_s, row_number() OVER (PARTITION BY endpoint ORDER BY duration_s) AS r,
  count(*) OVER (PARTITION BY endpoint) AS n FROM slog)
SELECT endpoint, p, duration_s AS value FROM r, (VALUES (CAST(0.1 AS DOUBLE)), (0.5), (0.9), (0.99), (1.0)) v(p)
WHERE r.r = least(floor(p * n), n - 1) + 1""")
def _(spark, sf):
    from emberline.operators.ranks import nearest_ranks
    return nearest_ranks(log(spark, sf), "duration_s", [0.1, 0.5, 0.9, 0.99, 1.0], ["endpoint"])


def alert_log(spark, sf):
    """Alert payloads as JSON text, one per event; a third hold no firing alert."""
    e = F.col("event_id")
    summary = F.concat(F.lit("p95 over limit for "), F.repeat(F.col("event_type"), (e % 20).cast("int")))

    def one(status, name):
        return F.struct(status.alias("status"), F.struct(name.alias("alertname")).alias("labels"),
                        F.struct(F.when(e % 5 != 0, summary).alias("summary")).alias("annotations"))
    status = F.when(e % 3 == 0, "resolved").otherwise("firing")
    alerts = F.array(one(F.lit("resolved"), F.lit("old")), one(status, F.when(e % 7 != 0, F.col("event_type"))))
    return D.table(spark, sf, "events").select(
        e.alias("event_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.to_json(F.struct(alerts.alias("alerts"))).alias("payload"))


ALERT_SQL = """parsed AS (
  SELECT event_id, ts, CASE WHEN event_id % 3 = 0 OR event_id % 7 = 0 THEN 'unknown' ELSE event_type END AS alert,
    CASE WHEN event_id % 3 = 0 THEN 'no firing alerts in payload'
      ELSE 'grafana_alert:' || CASE WHEN event_id % 7 = 0 THEN 'unknown' ELSE event_type END
        || CASE WHEN event_id % 5 <> 0
          THEN ' | ' || substring('p95 over limit for ' || repeat(event_type, event_id % 20), 1, 80) ELSE '' END
    END AS reason FROM events)"""


@query("alert_triggers", f"WITH {ALERT_SQL} SELECT event_id, alert, reason FROM parsed")
def _(spark, sf):
    parsed = L.parse_alert(F.col("payload"))
    return alert_log(spark, sf).select("event_id", parsed["alert"].alias("alert"), parsed["reason"].alias("reason"))


# Top-k feature: the history shows the last 50 triggers.
@query("recent_triggers", f"WITH {ALERT_SQL} SELECT ts, alert, reason, 'spawned' AS action FROM parsed ORDER BY ts DESC, reason DESC LIMIT 50")
def _(spark, sf):
    out = L.recent_triggers(L.trigger_rows(alert_log(spark, sf)), tie_break=("reason",))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


SPLIT = "2024-01-15"
PSI_BINS = range(10)


@query("stability_index", f"""WITH {D.det_sql('user')}, {DAILY_SQL},
long_form AS (SELECT 'hotspot_count' AS feature, CAST(hotspot_count AS DOUBLE) AS v, date > DATE '{SPLIT}' AS now FROM daily
  UNION ALL SELECT 'frp_mean', frp_mean, date > DATE '{SPLIT}' FROM daily),
ranked AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS r, count(*) OVER (PARTITION BY feature) AS n
  FROM long_form WHERE NOT now),
cuts AS (SELECT feature, v AS cut FROM ranked, range(1, 10) d(i) WHERE r = least(floor(CAST(i AS DOUBLE) / 10 * n), n - 1) + 1),
binned AS (SELECT l.feature, l.now, (SELECT count(*) FROM cuts c WHERE c.feature = l.feature AND c.cut < l.v) AS bin FROM long_form l),
tot AS (SELECT feature, now, count(*) AS n FROM binned GROUP BY ALL),
shares AS (SELECT t.feature, t.now, i AS bin, greatest(count(b.bin) / any_value(t.n), 1e-4) AS share
  FROM tot t JOIN range(0, 10) d(i) ON true LEFT JOIN binned b ON b.feature = t.feature AND b.now = t.now AND b.bin = i
  GROUP BY t.feature, t.now, i)
SELECT a.feature, round(sum((a.share - e.share) * ln(a.share / e.share)), 8) AS psi,
  sum((a.share - e.share) * ln(a.share / e.share)) > 0.2 AS drifted
FROM shares a JOIN shares e ON a.feature = e.feature AND a.bin = e.bin AND a.now AND NOT e.now GROUP BY a.feature""")
def _(spark, sf):
    # The ranks read the features three times: keep the daily rows, which are far fewer than detections.
    folder = new_folder(spark, "daily")
    A.aggregate_daily(D.detections(spark, sf, "user")).write.parquet(folder)
    daily = spark.read.parquet(folder)
    return rounded(G.stability_index(daily.filter(F.col("date") <= SPLIT), daily.filter(F.col("date") > SPLIT),
                                     ["hotspot_count", "frp_mean"]))


@query("training_window", f"""WITH {D.det_sql('user')}, {DAILY_SQL}
SELECT province_id, date, hotspot_count FROM daily WHERE date > DATE '2024-03-10' - 60 AND date <= DATE '2024-03-10'""")
def _(spark, sf):
    daily = A.aggregate_daily(D.detections(spark, sf, "user"))
    return G.training_window(daily, date(2024, 3, 10)).select("province_id", "date", "hotspot_count")


@query("event_days", f"""WITH {D.det_sql('user')}, {DAILY_SQL}
SELECT date, CAST(sum(hotspot_count) AS BIGINT) AS n_hotspots FROM daily GROUP BY date
  HAVING sum(hotspot_count) >= (SELECT avg(n) FROM (SELECT sum(hotspot_count) AS n FROM daily GROUP BY date))""")
def _(spark, sf):
    # The limit is the mean day, so that at every size there are days on both sides of it.
    daily = A.aggregate_daily(D.detections(spark, sf, "user"))
    return G.event_days(daily, daily.groupBy("date").agg(F.sum("hotspot_count").alias("n")).agg(F.avg("n")).scalar())


# RMSE of the persistence forecast in the first half against the second half.
@query("rmse_trigger", f"""WITH {D.det_sql('group')}, {DAILY_SQL},
p AS (SELECT *, lag(hotspot_count) OVER (PARTITION BY province_id ORDER BY date) AS pred FROM daily),
o AS (SELECT province_id, sqrt(avg((hotspot_count - pred) ** 2)) AS rmse FROM p WHERE date <= DATE '{SPLIT}' AND pred IS NOT NULL GROUP BY 1),
n AS (SELECT province_id, sqrt(avg((hotspot_count - pred) ** 2)) AS rmse, count(*) AS n_rows FROM p WHERE date > DATE '{SPLIT}' AND pred IS NOT NULL GROUP BY 1)
SELECT province_id, round(o.rmse, 8) AS old_rmse, round(n.rmse, 8) AS new_rmse, n_rows, n.rmse > o.rmse * 1.2 AS rmse_rose, n_rows >= 500 AS enough_rows
FROM o JOIN n USING (province_id)""")
def _(spark, sf):
    daily = W.add_lags(A.aggregate_daily(D.detections(spark, sf, "group")), (1,)).dropna(subset=["hotspot_count_lag_1d"])

    def half(side):
        return M.regression_metrics(side, "hotspot_count", "hotspot_count_lag_1d", ["province_id"])
    return rounded(G.rmse_trigger(half(daily.filter(F.col("date") <= SPLIT)), half(daily.filter(F.col("date") > SPLIT))))
