"""Detections to one row per entity and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators.cleaning import require_columns
from emberline.operators.enrich import assert_unique


def aggregate_daily(df: DataFrame, date: str = "acq_date_wib", entity: str = S.ENTITY) -> DataFrame:
    """Counts, fire power, day, night and high-confidence counts, and weather when present.

    One aggregation with map-side partials: a hot entity costs one row per day and map task.
    Weather is the same on every row of a group, so max picks it without caring about order.
    """
    require_columns(df, [entity, date, "frp"], "daily aggregate input")
    aggs = [
        F.count(F.lit(1)).alias("hotspot_count"),
        F.avg("frp").alias("frp_mean"),
        F.max("frp").alias("frp_max"),
        F.coalesce(F.sum("frp"), F.lit(0.0)).alias("frp_sum"),
    ]
    if "daynight" in df.columns:
        letter = F.upper("daynight")
        aggs += [F.count_if(letter == "D").alias("n_daytime"), F.count_if(letter == "N").alias("n_nighttime")]
    if "confidence" in df.columns:
        aggs.append(F.count_if(F.lower("confidence") == "h").alias("n_confidence_high"))
    aggs += [F.max(c).alias(c) for c in S.WEATHER if c in df.columns]
    return (df.dropna(subset=[entity, date])
            .groupBy(F.col(entity), F.col(date).cast("date").alias("date"))
            .agg(*aggs))


def join_daily_weather(daily: DataFrame, weather: DataFrame, entity: str = S.ENTITY) -> DataFrame:
    """Weather added after the aggregation: the join moves days, not detections.

    Equal to joining each detection first, because weather is unique per entity and day; a second row for
    a key fails the job.
    """
    columns = [c for c in S.WEATHER if c in weather.columns]
    right = assert_unique(weather.select(F.col(S.ENTITY).alias(entity), "date", *columns), [entity, "date"], "weather")
    return daily.join(right, [entity, "date"], "left")


def count_daily(df: DataFrame, date: str = "acq_date", entity: str = S.ENTITY) -> DataFrame:
    return (df.dropna(subset=[date, entity])
            .groupBy(F.to_date(date).alias("acq_date"), F.col(entity))
            .agg(F.count(F.lit(1)).alias("hotspot_count")))


def fill_calendar(daily: DataFrame, entity: str = S.ENTITY) -> DataFrame:
    """A row for each day between an entity's first and last; days without detections count 0.

    Each observed day is stretched up to the next one, so no calendar table or join is needed.
    """
    w = Window.partitionBy(entity).orderBy("date")
    zero = {"hotspot_count", "frp_sum", "n_daytime", "n_nighttime", "n_confidence_high"}
    until = F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.col("date"))
    stretched = (daily.withColumn("_until", until)
                 .withColumn("_day", F.explode(F.sequence("date", "_until", F.expr("interval 1 day")))))
    real = F.col("_day") == F.col("date")
    values = [F.when(real, F.col(c)).otherwise(F.lit(0 if c in zero else None).cast(t)).alias(c)
              for c, t in daily.dtypes if c not in (entity, "date")]
    return stretched.select(entity, F.col("_day").alias("date"), *values)
