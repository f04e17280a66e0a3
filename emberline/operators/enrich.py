"""Detections joined with daily context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators.joins import salted_left_join


def assert_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Fail the job, when it runs, if a key occurs twice. No extra pass over the data.

    The check rides on an aggregation by the join keys, so the join reuses its shuffle.
    """
    values = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"),
                                    *[F.max(c).alias(c) for c in values])
    unique = F.when(F.col("_copies") > 1,
                    F.raise_error(F.lit(f"{what}: more than one row for a key")).cast("boolean")
                    ).otherwise(F.lit(True))
    return grouped.filter(unique).select(*df.columns)


def join_weather(detections: DataFrame, weather: DataFrame | None, date: str = "acq_date_wib",
                 salts: int = 1, validate: bool = True) -> DataFrame:
    """Every detection with the weather of its entity and local day, null where there is none."""
    if weather is None:
        return detections
    columns = [c for c in S.WEATHER if c in weather.columns]
    right = weather.select(S.ENTITY, F.col("date").alias(date), *columns)
    if validate:
        right = assert_unique(right, [S.ENTITY, date], "weather")
    joined = salted_left_join(detections, right, [S.ENTITY, date],
                              ["latitude", "longitude", "acq_datetime_utc"], salts)
    return joined.select(*detections.columns, *columns)


def unmatched(detections: DataFrame, weather: DataFrame, date: str = "acq_date_wib") -> DataFrame:
    """Detections without weather, counted per entity and day before the join, then summed."""
    per_day = (detections.groupBy(S.ENTITY, date).agg(F.count(F.lit(1)).alias("n")))
    missing = per_day.join(weather.select(S.ENTITY, F.col("date").alias(date)), [S.ENTITY, date], "left_anti")
    return missing.groupBy(S.ENTITY).agg(F.sum("n").alias("n_unmatched"))
