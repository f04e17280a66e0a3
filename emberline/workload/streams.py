"""Streaming queries: the whole table as a stream, appended to a table, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.operators.requests import add_status
from emberline.session import new_folder
from emberline.streaming import detections as V
from emberline.streaming import requests as Q
from emberline.streaming import runs as J
from emberline.workload import standins as D
from emberline.workload.monitoring import ALERT_SQL, LOG, SUSTAINED_SQL, alert_log, ended, quantile_ctes, slides
from emberline.workload.features import rounded
from emberline.workload.registry import query
from emberline import schemas as S


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def finished(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """The stream's result after all available input."""
    folder = new_folder(spark, name)
    J.append_available(stream, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def stream_log(spark, sf):
    return add_status(D.log_of(events_stream(spark, sf))).select("ts", "status", "duration_s", "prediction")


# The watermark trails the newest row by the delay; a window is out once it has passed its end.
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM slog)"


@query("stream_dedup", f"""WITH {D.det_sql()}
SELECT latitude, longitude, acq_datetime_utc, satellite, count(*) AS n FROM det GROUP BY ALL""")
def _(spark, sf):
    det = D.from_events(events_stream(spark, sf))
    copies = det.withColumn("copy", F.explode(F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    out = finished(spark, V.dedup(copies).select(*V.KEYS), "dedup")
    return out.groupBy("latitude", "longitude", F.col("acq_datetime_utc").cast("timestamp_ntz").alias("acq_datetime_utc"),
                       "satellite").agg(F.count(F.lit(1)).alias("n"))


# What the watermark has passed is out; the rows are those of the batch form.
@query("stream_dedup_first", f"""WITH {D.det_sql()}, {D.DUP_SQL}
SELECT event_id, province_id, priority, frp FROM (
  SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_datetime_utc, satellite ORDER BY priority, event_id) AS rn FROM dup)
WHERE rn = 1 AND acq_datetime_utc <= (SELECT max(acq_datetime_utc) - INTERVAL 1 HOUR FROM det)""")
def _(spark, sf):
    copies = D.with_duplicates(D.from_events(events_stream(spark, sf)))
    first = V.dedup_first(copies, [F.col("priority"), F.col("event_id")])
    return finished(spark, first.select("event_id", "province_id", "priority", "frp"), "first")


@query("stream_daily_counts", f"""WITH {D.det_sql('user')}
SELECT acq_date AS date, province_id, count(*) AS hotspot_count FROM det
WHERE acq_date + INTERVAL 1 DAY <= (SELECT max(acq_datetime_utc) - INTERVAL 1 HOUR FROM det) GROUP BY ALL""")
def _(spark, sf):
    return finished(spark, V.daily_counts(D.from_events(events_stream(spark, sf), "user")), "daily")


@query("stream_daily_counts_local", f"""WITH {D.det_sql()}
SELECT acq_date_wib AS date, province_id, count(*) AS hotspot_count FROM det
WHERE acq_date_wib + INTERVAL 1 DAY - INTERVAL 7 HOUR <= (SELECT max(acq_datetime_utc) - INTERVAL 1 HOUR FROM det) GROUP BY ALL""")
def _(spark, sf):
    return finished(spark, V.daily_counts(D.from_events(events_stream(spark, sf)), offset_hours=7), "local")


@query("stream_request_stats", f"""WITH {LOG}, {slides()}
SELECT window_end, count(*) AS n, count(*) FILTER (status IN ('4xx', '5xx')) AS n_errors,
  {', '.join(f"count(*) FILTER (duration_s <= CAST({b} AS DOUBLE)) AS le_{i}" for i, b in enumerate(S.DURATION_BOUNDS))},
  count(duration_s) AS le_total, round(count(*) FILTER (status IN ('4xx', '5xx')) / count(*), 8) AS error_rate
FROM slid WHERE {CLOSED} GROUP BY window_end""")
def _(spark, sf):
    return rounded(ended(finished(spark, Q.request_stats(stream_log(spark, sf)), "stats")))


@query("stream_latency_alert", f"""WITH {LOG}, {slides()}, {quantile_ctes('duration_s', S.DURATION_BOUNDS, 0.95)},
closed AS (SELECT * FROM quant WHERE {CLOSED}),
{SUSTAINED_SQL.format(cond='value > 1.0', source='closed', m=5)}""")
def _(spark, sf):
    series = finished(spark, Q.latency_series(stream_log(spark, sf)), "latency")
    return ended(Q.latency_alert(series))


# The join's watermark is the slower side's: the unshifted one.
@query("stream_drift_alert", f"""WITH {LOG}, {slides()}, {quantile_ctes('prediction', S.PREDICTION_BOUNDS, 0.95)},
ratios AS (SELECT a.window_end, a.value / CASE WHEN b.value IS NOT NULL THEN greatest(b.value, 0.1) END AS ratio
  FROM quant a JOIN quant b ON a.window_end = b.window_end + INTERVAL 1 HOUR WHERE a.{CLOSED}),
{SUSTAINED_SQL.format(cond='ratio > 1.5', source='ratios', m=10)}""")
def _(spark, sf):
    series = Q.drift_series(stream_log(spark, sf), stream_log(spark, sf))
    return ended(Q.drift_alert(finished(spark, series, "drift")))


# Islands of evaluations that hold; a run is out once the watermark has passed its gap.
RUNS_SQL = """held AS (SELECT window_end, window_end - row_number() OVER (ORDER BY window_end) * INTERVAL 1 MINUTE AS island
  FROM {source} WHERE {cond})
SELECT '{alert}' AS alert, min(window_end) AS held_from, min(window_end) + INTERVAL {m} MINUTE AS firing_from, max(window_end) AS held_to, count(*) AS n_evaluations
FROM held GROUP BY island HAVING count(*) > {m} AND max(window_end) + INTERVAL 90 SECOND <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM slog)"""


def naive(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("held_from", "firing_from", "held_to")})


@query("stream_latency_runs", f"""WITH {LOG}, {slides()}, {quantile_ctes('duration_s', S.DURATION_BOUNDS, 0.95)},
{RUNS_SQL.format(cond='value > 1.0', source='quant', m=5, alert='latency')}""")
def _(spark, sf):
    return naive(finished(spark, Q.latency_runs(stream_log(spark, sf)), "latency-runs"))


@query("stream_drift_runs", f"""WITH {LOG}, {slides()}, {quantile_ctes('prediction', S.PREDICTION_BOUNDS, 0.95)},
ratios AS (SELECT a.window_end, a.value / CASE WHEN b.value IS NOT NULL THEN greatest(b.value, 0.1) END AS ratio
  FROM quant a JOIN quant b ON a.window_end = b.window_end + INTERVAL 1 HOUR),
{RUNS_SQL.format(cond='ratio > 0.9', source='ratios', m=2, alert='drift')}""")
def _(spark, sf):
    log = stream_log(spark, sf)
    return naive(finished(spark, Q.drift_runs(log, stream_log(spark, sf), 0.9, 2), "drift-runs"))


@query("stream_triggers_once", f"WITH {ALERT_SQL} SELECT ts, alert, reason, 'spawned' AS action FROM parsed")
def _(spark, sf):
    """The trigger log twice over one checkpoint, and its batch once more by hand: no row comes twice."""
    folder, log = new_folder(spark, "alerts"), new_folder(spark, "trigger-log")
    alert_log(spark, sf).select("ts", "payload").write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(folder)
    rows = J.triggers(spark, folder)
    for _round in range(2):
        J.add_available(rows, log, f"{log}-checkpoint", "alerts")
    out = J.read_batches(spark, log, rows.schema)
    J.batch_writer(log, "alerts")(out.drop("stream", "batch"), 0)
    return out.drop("stream", "batch").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_triggers", f"WITH {ALERT_SQL} SELECT ts, alert, reason, 'spawned' AS action FROM parsed")
def _(spark, sf):
    folder = new_folder(spark, "alerts")
    alert_log(spark, sf).select("ts", "payload").write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(folder)
    return finished(spark, J.triggers(spark, folder), "triggers").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
