"""Request and prediction monitoring over a log of requests.

The log has `ts`, `endpoint`, `status` (class text), `duration_s` and `prediction`. Windows
carry their end as `window_end`, as an evaluation at that time would see them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.histogram import bucket_counts, bucket_names, bucket_quantile, bucket_upper_bound
from emberline.functions.risk import status_class
from emberline.operators.ranks import nearest_ranks


def add_status(log: DataFrame, code: str = "code") -> DataFrame:
    return log.withColumn("status", status_class(F.col(code)))


def minute_of(ts: str = "ts") -> Column:
    return F.date_trunc("minute", ts)


def slide(per_minute: DataFrame, by: Sequence[str], minutes: int = 5) -> DataFrame:
    """Minute counts to counts over the last `minutes` minutes, at every minute that sees any.

    Only per-minute aggregates are repeated `minutes` times, never the log rows.
    """
    values = [c for c in per_minute.columns if c not in ("minute", *by)]
    ends = F.sequence(F.col("minute") + F.expr("interval 1 minute"),
                      F.col("minute") + F.make_dt_interval(mins=F.lit(minutes)), F.expr("interval 1 minute"))
    return (per_minute.withColumn("window_end", F.explode(ends))
            .groupBy("window_end", *by).agg(*[F.sum(c).alias(c) for c in values]))


def request_rate(log: DataFrame, minutes: int = 1, by: Sequence[str] = ("status",)) -> DataFrame:
    """Requests and requests per second in tumbling windows."""
    w = F.window("ts", f"{minutes} minutes")
    return (log.groupBy(w, *by).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.end").alias("window_end"), *by, "n",
                    (F.col("n") / F.lit(60.0 * minutes)).alias("per_second")))


def error_rate(log: DataFrame, minutes: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """Share of 4xx and 5xx among all requests of the last `minutes` minutes."""
    per_minute = log.groupBy(minute_of().alias("minute"), *by).agg(
        F.count_if(F.col("status").isin("4xx", "5xx")).alias("n_errors"), F.count(F.lit(1)).alias("n"))
    return slide(per_minute, by, minutes).withColumn(
        "error_rate", F.col("n_errors") / F.greatest(F.col("n").cast("double"), F.lit(1e-9)))


def sliding_histogram(log: DataFrame, value: str, bounds: list[float], minutes: int = 5,
                      by: Sequence[str] = (), prefix: str = "le") -> DataFrame:
    """Cumulative bucket counts over the last `minutes` minutes, at every minute."""
    per_minute = log.groupBy(minute_of().alias("minute"), *by).agg(*bucket_counts(F.col(value), bounds, prefix))
    return slide(per_minute, by, minutes)


def histogram_rows(hist: DataFrame, bounds: list[float], by: Sequence[str] = (), prefix: str = "le") -> DataFrame:
    """Wide cumulative counts to one row per upper bound; the last bound is infinity."""
    names = bucket_names(bounds, prefix)
    pairs = [F.struct(F.lit(b).alias("le"), F.col(n).alias("n"))
             for b, n in zip([*bounds, float("inf")], names)]
    return hist.select("window_end", *by, F.inline(F.array(*pairs)))


def window_quantiles(hist: DataFrame, bounds: list[float], quantiles: dict[str, float],
                     by: Sequence[str] = (), prefix: str = "le") -> DataFrame:
    return hist.select("window_end", *by, *[
        bucket_quantile(q, bounds, prefix).alias(name) for name, q in quantiles.items()])


def prediction_heatmap(log: DataFrame, minutes: int = 5) -> DataFrame:
    """Predictions per value bucket (not cumulative) in tumbling windows."""
    le = bucket_upper_bound(F.col("prediction"), S.PREDICTION_BOUNDS)
    return (log.filter(F.col("prediction").isNotNull())
            .groupBy(F.window("ts", f"{minutes} minutes"), le.alias("le")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.end").alias("window_end"), "le", "n"))


def compare_with_earlier(series: DataFrame, value: str, hours: int = 1, floor: float = 0.1) -> DataFrame:
    """Value now over the value `hours` before, the base held at `floor` or more.

    A window without a base drops out; a null base gives a null ratio.
    """
    base = series.select((F.col("window_end") + F.make_dt_interval(hours=F.lit(hours))).alias("window_end"),
                         F.col(value).alias("base"))
    return (series.select("window_end", F.col(value).alias("now")).join(base, "window_end")
            .withColumn("ratio", F.col("now") / F.when(F.col("base").isNotNull(), F.greatest("base", F.lit(floor)))))


def sustained(evaluations: DataFrame, condition: Column, minutes: int, by: Sequence[str] = ()) -> DataFrame:
    """`firing` where the condition held at this evaluation and at each of the last `minutes` ones.

    A missing evaluation breaks the run. Each true evaluation votes for itself and the
    `minutes` after it, so this is an aggregation by time, not a sort of the whole series.
    """
    votes = F.sequence(F.col("window_end"), F.col("window_end") + F.make_dt_interval(mins=F.lit(minutes)),
                       F.expr("interval 1 minute"))
    flagged = evaluations.select(*by, "window_end", F.coalesce(condition, F.lit(False)).alias("holds"))
    own = flagged.select(*by, "window_end", "holds", F.lit(True).alias("_own"), F.lit(0).alias("_vote"))
    cast = flagged.filter("holds").select(
        *by, F.explode(votes).alias("window_end"), F.lit(False).alias("holds"), F.lit(False).alias("_own"),
        F.lit(1).alias("_vote"))
    return (own.unionByName(cast).groupBy(*by, "window_end")
            .agg(F.max("holds").alias("holds"), F.max("_own").alias("_own"), F.sum("_vote").alias("_votes"))
            .filter("_own")
            .select(*by, "window_end", "holds", (F.col("_votes") == minutes + 1).alias("firing")))


def latency_alert(log: DataFrame, threshold: float = 1.0, q: float = 0.95, minutes: int = 5) -> DataFrame:
    hist = sliding_histogram(log, "duration_s", S.DURATION_BOUNDS)
    p = window_quantiles(hist, S.DURATION_BOUNDS, {"value": q})
    return sustained(p, F.col("value") > threshold, minutes)


def drift_alert(log: DataFrame, threshold: float = 1.5, q: float = 0.95, minutes: int = 10) -> DataFrame:
    hist = sliding_histogram(log, "prediction", S.PREDICTION_BOUNDS)
    p = window_quantiles(hist, S.PREDICTION_BOUNDS, {"value": q})
    return sustained(compare_with_earlier(p, "value"), F.col("ratio") > threshold, minutes)


def running_total(steps: DataFrame, value: str, ts: str, out: str) -> DataFrame:
    """Running sum over time in two levels: totals per day, then steps inside each day.

    No task holds more than one day of steps, or one row per day.
    """
    daily = steps.withColumn("_day", F.to_date(ts))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (daily.groupBy("_day").agg(F.sum(value).alias("_sum"))
               .select("_day", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")))
    inside = F.sum(value).over(Window.partitionBy("_day").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0))
    return daily.join(offsets, "_day").withColumn(out, F.col("_offset") + inside).drop("_day", "_offset")


def active_requests(log: DataFrame, seconds: int = 15) -> DataFrame:
    """Requests in flight at the end of each sampling step that saw a start or an end.

    Starts and ends are netted per step first, so the running sum covers steps, not requests.
    """
    end = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("duration_s") * 1000000).cast("long"))
    moves = log.select(F.inline(F.array(F.struct(F.col("ts").alias("at"), F.lit(1).alias("delta")),
                                        F.struct(end.alias("at"), F.lit(-1).alias("delta")))))
    step = F.timestamp_seconds((F.floor(F.unix_seconds("at") / seconds) + 1) * seconds)
    steps = moves.groupBy(step.alias("step_end")).agg(F.sum("delta").alias("_delta"))
    return running_total(steps, "_delta", "step_end", "active").select("step_end", "active")


def load_summary(results: DataFrame, elapsed_s: Column, by: Sequence[str]) -> DataFrame:
    """Totals, success share, throughput and exact nearest-rank latencies per load run.

    `by` names the run. Only status 200 is a success, and only successes have a latency.
    `elapsed_s` is an aggregate over the results, or a literal.
    """
    by, ok = list(by), F.col("code") == 200
    totals = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(ok).alias("n_ok"), elapsed_s.alias("elapsed_s"),
        F.min(F.when(ok, F.col("elapsed_ms"))).alias("min_ms"), F.max(F.when(ok, F.col("elapsed_ms"))).alias("max_ms"),
        F.count(F.when(ok, F.col("prediction"))).alias("n_predictions"),
        F.min(F.when(ok, F.col("prediction"))).alias("prediction_min"),
        F.max(F.when(ok, F.col("prediction"))).alias("prediction_max"))
    values = results.filter(ok).unpivot(by, ["elapsed_ms", "prediction"], "_what", "_value")
    found = nearest_ranks(values, "_value", [0.5, 0.95, 0.99], [*by, "_what"])

    def rank(what: str, p: float, name: str) -> Column:
        return F.max(F.when((F.col("_what") == what) & (F.col("p") == p), F.col("value"))).alias(name)
    ranks = found.groupBy(*by).agg(
        rank("elapsed_ms", 0.5, "p50_ms"), rank("elapsed_ms", 0.95, "p95_ms"), rank("elapsed_ms", 0.99, "p99_ms"),
        rank("prediction", 0.5, "prediction_median"))
    return totals.join(ranks, by, "left").select(
        *by, "n_total", "n_ok", (F.col("n_total") - F.col("n_ok")).alias("n_failed"),
        (F.col("n_ok") * F.lit(100.0) / F.col("n_total")).alias("success_pct"),
        (F.col("n_total") / F.nullif(F.col("elapsed_s"), F.lit(0.0))).alias("throughput"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms", "min_ms", "max_ms")],
        "n_predictions", "prediction_min", "prediction_median", "prediction_max")
