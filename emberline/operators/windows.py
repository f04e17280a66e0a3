"""Row-based training features and calendar-based serving features over daily rows.

Everything here runs on daily rows, so the largest window partition is one entity's number of
days, however many detections it has. All training features share one partition and order:
Spark plans one shuffle and one sort for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.calendar import calendar_features


def series(entity: str = S.ENTITY) -> WindowSpec:
    return Window.partitionBy(entity).orderBy("date")


def rolling_columns(windows=S.WINDOWS, entity: str = S.ENTITY) -> dict[str, Column]:
    """Sum of counts and mean of daily frp means over the previous w rows, today left out."""
    out = {}
    for w in windows:
        frame = series(entity).rowsBetween(-w, -1)
        out[f"hotspot_count_{w}d"] = F.sum("hotspot_count").over(frame).cast("double")
        out[f"frp_mean_{w}d"] = F.avg("frp_mean").over(frame)
    return out


def lag_columns(lags=S.WINDOWS, entity: str = S.ENTITY) -> dict[str, Column]:
    return {f"hotspot_count_lag_{n}d": F.lag("hotspot_count", n).over(series(entity)).cast("double")
            for n in lags}


def target_column(horizon: int = S.HORIZON, entity: str = S.ENTITY) -> Column:
    return F.lead("hotspot_count", horizon).over(series(entity)).cast("double")


def add_calendar(daily: DataFrame) -> DataFrame:
    return daily.withColumns(calendar_features(F.col("date")))


def add_rolling(daily: DataFrame, windows=S.WINDOWS, entity: str = S.ENTITY) -> DataFrame:
    return daily.withColumns(rolling_columns(windows, entity))


def add_lags(daily: DataFrame, lags=S.WINDOWS, entity: str = S.ENTITY) -> DataFrame:
    return daily.withColumns(lag_columns(lags, entity))


def add_days_since_rain(daily: DataFrame, threshold: float = S.RAIN_MM, entity: str = S.ENTITY) -> DataFrame:
    """Rows since the last rainy one; 0 before the first rain; missing rain counts as dry.

    Row number minus the row number of the last rain: same partition and order as the other
    features, so no further sort.
    """
    if "precipitation_sum" not in daily.columns:
        return daily.withColumn("days_since_rain", F.lit(None).cast("long"))
    w = series(entity)
    numbered = daily.withColumn("_row", F.row_number().over(w))
    rained = F.max(F.when(F.col("precipitation_sum") >= threshold, F.col("_row"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    return (numbered.withColumn("days_since_rain", F.coalesce(F.col("_row") - rained, F.lit(0)).cast("long"))
            .drop("_row"))


def latest_per_entity(df: DataFrame, entity: str = S.ENTITY) -> DataFrame:
    """Newest day per entity, by an aggregation that keeps one candidate per task."""
    rest = [c for c in df.columns if c != entity]
    return (df.groupBy(entity).agg(F.max_by(F.struct(*rest), F.col("date")).alias("_row"))
            .select(entity, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def last_days(df: DataFrame, days: int = 8, date: str = "acq_date") -> DataFrame:
    """Rows of the last `days` days, counted back from the newest day of the whole set."""
    newest = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date) >= F.date_sub(newest, days))


def serving_daily(df: DataFrame, date: str = "acq_date", entity: str = S.ENTITY) -> DataFrame:
    """Daily rows for serving: as `aggregate_daily`, with the number of frp values for weighting."""
    letter = F.upper("daynight")
    return (df.dropna(subset=[entity, date])
            .groupBy(entity, F.col(date).alias("date"))
            .agg(F.count(F.lit(1)).alias("hotspot_count"),
                 F.coalesce(F.avg("frp"), F.lit(0.0)).alias("frp_mean"),
                 F.coalesce(F.max("frp"), F.lit(0.0)).alias("frp_max"),
                 F.coalesce(F.sum("frp"), F.lit(0.0)).alias("frp_sum"),
                 F.count("frp").alias("frp_n"),
                 F.count_if(letter == "D").alias("n_daytime"),
                 F.count_if(letter == "N").alias("n_nighttime"),
                 F.count_if(F.lower("confidence") == "h").alias("n_confidence_high")))


def serving_columns(windows=S.WINDOWS, entity: str = S.ENTITY) -> dict[str, Column]:
    """Counts over the last d calendar days, today included; the detection-weighted frp mean of
    the same days; the count exactly d days back. Empty frames give 0."""
    by_day = Window.partitionBy(entity).orderBy(F.unix_date("date"))
    out = {}
    for d in windows:
        frame = by_day.rangeBetween(-(d - 1), 0)
        weight = F.sum("frp_n").over(frame)
        out[f"hotspot_count_{d}d"] = F.sum("hotspot_count").over(frame).cast("double")
        out[f"frp_mean_{d}d"] = F.when(weight > 0, F.sum("frp_sum").over(frame) / weight).otherwise(F.lit(0.0))
        out[f"hotspot_count_lag_{d}d"] = F.coalesce(
            F.sum("hotspot_count").over(by_day.rangeBetween(-d, -d)), F.lit(0)).cast("double")
    return out


def add_serving_windows(daily: DataFrame, windows=S.WINDOWS, entity: str = S.ENTITY) -> DataFrame:
    return daily.withColumns(serving_columns(windows, entity))
