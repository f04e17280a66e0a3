"""Request-log streams: the sliding windows of the dashboards and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.histogram import bucket_counts
from emberline.operators.requests import sustained, window_quantiles

WINDOW, STEP = "5 minutes", "1 minute"


def _sliding(log: DataFrame, delay: str, counts: list) -> DataFrame:
    """Counts per minute, then their sums over the windows that a minute lies in: a log row is counted once,
    and only minutes are repeated for the overlapping windows."""
    minutes = log.withWatermark("ts", delay).groupBy(F.window("ts", STEP)).agg(*counts)
    names = [c for c in minutes.columns if c != "window"]
    return minutes.groupBy(F.window(F.window_time("window"), WINDOW, STEP)).agg(*[F.sum(c).alias(c) for c in names])


def request_stats(log: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Counts, error share and duration buckets over the last five minutes, every minute."""
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("status").isin("4xx", "5xx")).alias("n_errors"),
              *bucket_counts(F.col("duration_s"), S.DURATION_BOUNDS, "le")]
    return (_sliding(log, delay, counts)
            .withColumn("error_rate", F.col("n_errors") / F.greatest(F.col("n").cast("double"), F.lit(1e-9)))
            .withColumn("window_end", F.col("window.end")).drop("window"))


def latency_series(log: DataFrame, q: float = 0.95, delay: str = "10 minutes") -> DataFrame:
    hist = _sliding(log, delay, bucket_counts(F.col("duration_s"), S.DURATION_BOUNDS, "le")).withColumn("window_end", F.col("window.end"))
    return window_quantiles(hist, S.DURATION_BOUNDS, {"value": q})


def _prediction_series(log: DataFrame, q: float, delay: str, value: str) -> DataFrame:
    """`window_time` is kept and `window` dropped: a later join needs one event time per side."""
    hist = (_sliding(log, delay, bucket_counts(F.col("prediction"), S.PREDICTION_BOUNDS, "le"))
            .withColumn("window_end", F.window_time("window")).drop("window"))
    return window_quantiles(hist, S.PREDICTION_BOUNDS, {value: q})


def drift_series(log: DataFrame, earlier: DataFrame, q: float = 0.95, hours: int = 1, floor: float = 0.1,
                 delay: str = "10 minutes") -> DataFrame:
    """Quantile now over the quantile `hours` before, joined on shifted event time.

    `earlier` is a second reading of the same log. Shifting its times before the windows makes
    the join an equality on window time, which is what bounds the join's state.
    """
    shifted = earlier.withColumn("ts", F.col("ts") + F.make_dt_interval(hours=F.lit(hours)))
    now = _prediction_series(log, q, delay, "now")
    base = _prediction_series(shifted, q, delay, "base").withColumnRenamed("window_end", "base_end")
    return (now.join(base, F.col("window_end") == F.col("base_end"))
            .select("window_end", "now", "base",
                    (F.col("now") / F.when(F.col("base").isNotNull(), F.greatest("base", F.lit(floor)))).alias("ratio")))


def drift_alert(series: DataFrame, threshold: float = 1.5, minutes: int = 10) -> DataFrame:
    """The sustained condition over the table that `drift_series` appends to."""
    ended = series.withColumn("window_end", F.timestamp_micros(F.unix_micros("window_end") + 1))
    return sustained(ended, F.col("ratio") > threshold, minutes)


def latency_alert(series: DataFrame, threshold: float = 1.0, minutes: int = 5) -> DataFrame:
    return sustained(series, F.col("value") > threshold, minutes)


def alert_runs(series: DataFrame, condition: Column, minutes: int, alert: str, at: str = "window_end") -> DataFrame:
    """Runs of evaluations that hold, as they end: one row per run that held for `minutes`, out of the stream itself.

    `at` is the event time of a series with one evaluation a minute, as `window_time` gives it. Evaluations that hold
    make sessions; one that is missing, null or false leaves more than the gap of 90 seconds and ends the run. A run comes out
    once the watermark has passed its end. The state holds one row per open run. Spark wants a key beside a session: the
    alert's name, taken from the row, since a constant key would be optimised away.
    """
    name = F.when(F.col(at).isNotNull(), alert)
    runs = (series.filter(condition).groupBy(name.alias("alert"), F.session_window(at, "90 seconds"))
            .agg(F.min(at).alias("_from"), F.max(at).alias("_to"), F.count(F.lit(1)).alias("n_evaluations"))
            .filter(F.col("n_evaluations") > minutes))
    held_from, held_to = (F.timestamp_micros(F.unix_micros(c) + 1) for c in ("_from", "_to"))
    return runs.select("alert", held_from.alias("held_from"), (held_from + F.make_dt_interval(mins=F.lit(minutes))).alias("firing_from"),
                       held_to.alias("held_to"), "n_evaluations")


def latency_runs(log: DataFrame, threshold: float = 1.0, q: float = 0.95, minutes: int = 5, delay: str = "10 minutes") -> DataFrame:
    hist = (_sliding(log, delay, bucket_counts(F.col("duration_s"), S.DURATION_BOUNDS, "le"))
            .withColumn("window_end", F.window_time("window")).drop("window"))
    return alert_runs(window_quantiles(hist, S.DURATION_BOUNDS, {"value": q}), F.col("value") > threshold, minutes, "latency")


def drift_runs(log: DataFrame, earlier: DataFrame, threshold: float = 1.5, minutes: int = 10, **series) -> DataFrame:
    return alert_runs(drift_series(log, earlier, **series), F.col("ratio") > threshold, minutes, "drift")
