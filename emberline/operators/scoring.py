"""Feature encoding for a model, and forecasts to risk rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.calendar import calendar_features
from emberline.functions.risk import risk_label, risk_level


def encode_features(df: DataFrame, keep: list[str]) -> DataFrame:
    """The 27 features in model order and model types; null or absent becomes 0."""
    def encoded(c: str):
        kind = "int" if c in S.INT_FEATURES else "long" if c in S.LONG_FEATURES else "double"
        value = F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0)
        return value.cast(kind).alias(c)
    return df.select(*keep, *[encoded(c) for c in S.FEATURES])


def with_weather_constants(df: DataFrame) -> DataFrame:
    """The dashboard has no weather: constants replace whatever is there."""
    constants = {c: F.lit(v) for c, v in S.WEATHER_CONSTANTS.items()}
    return df.withColumns({**constants, "days_since_rain": F.lit(S.DRY_DAYS_CONSTANT).cast("long")})


def serving_features(served: DataFrame, keep: list[str]) -> DataFrame:
    """Serving windows, calendar and weather constants, encoded for the model."""
    dated = served.withColumns(calendar_features(F.col("date")))
    return encode_features(with_weather_constants(dated), keep)


def add_risk(df: DataFrame, count: str = "prediction_count") -> DataFrame:
    leveled = df.withColumn("risk_level", risk_level(F.col(count)))
    return leveled.withColumn("risk_label", risk_label(F.col("risk_level")))


def prediction_rows(scored: DataFrame) -> DataFrame:
    """Scored feature rows to output rows; a failed score stays null, with null risk."""
    rows = scored.select(
        S.ENTITY, F.coalesce("hotspot_count", F.lit(0)).cast("long").alias("today_count"),
        F.col("date").alias("date_today"), F.col("prediction").cast("double").alias("prediction_count"))
    return add_risk(rows)


def prediction_totals(predictions: DataFrame) -> DataFrame:
    """Sums over rows that have a prediction; the others count in neither total."""
    return predictions.filter(F.col("prediction_count").isNotNull()).agg(
        F.coalesce(F.sum("today_count"), F.lit(0)).alias("total_today"),
        F.coalesce(F.sum("prediction_count"), F.lit(0.0)).alias("total_tomorrow"))


def attach_forecast(areas: DataFrame, forecast: DataFrame) -> DataFrame:
    """Every area, with its forecast if there is one; the id stands in for a missing name."""
    return areas.join(forecast, S.ENTITY, "left").withColumn("name", F.coalesce("name", S.ENTITY))
