"""Filters, counts and map data behind the dashboard."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions import clean
from emberline.functions.calendar import inclusive_days
from emberline.functions.hashing import hash_text
from emberline.functions.risk import LEVEL_RANK, confidence_rank
from emberline.operators.daily import count_daily


def prepare_hotspots(raw: DataFrame) -> DataFrame:
    """Raw text detections to dashboard rows: UTC date, no de-duplication, bad frp kept as null."""
    out = raw.withColumns({
        "acq_date": F.substring(F.trim(F.col("acq_date").cast("string")), 1, 10).try_cast("date"),
        **{c: clean.clean_double(F.col(c)) for c in ("latitude", "longitude", "frp")}})
    if "confidence" in raw.columns:
        out = out.withColumn("confidence", clean.clean_text(F.col("confidence")))
    return out.dropna(subset=["acq_date", "latitude", "longitude"])


def filter_hotspots(df: DataFrame, start: Date | str, end: Date | str, entities: list[str] | None = None,
                    min_confidence: str = "low") -> DataFrame:
    """Inclusive dates; no entities means all of them; an unknown level means low."""
    keep = F.col("acq_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if entities:
        keep = keep & F.col(S.ENTITY).isin(entities)
    level = LEVEL_RANK.get(min_confidence, 0)
    if level and "confidence" in df.columns:
        keep = keep & (confidence_rank(F.col("confidence")) >= level)
    return df.filter(keep)


def default_range(df: DataFrame, days: int = 30) -> DataFrame:
    """The last `days` days of data, not before its start."""
    span = df.agg(F.min("acq_date").alias("first"), F.max("acq_date").alias("last"))
    return span.select(F.greatest("first", F.date_sub("last", days)).alias("start"), F.col("last").alias("end"))


def in_default_range(df: DataFrame, days: int = 30) -> DataFrame:
    return df.filter(F.col("acq_date") >= default_range(df, days).select("start").scalar())


def pivot_daily(df: DataFrame, entities: list[str]) -> DataFrame:
    """Dates by entities, 0 where there is nothing. Pivots the daily counts, not the detections."""
    daily = count_daily(df.filter(F.col(S.ENTITY).isin(entities)))
    return daily.groupBy("acq_date").pivot(S.ENTITY, entities).sum("hotspot_count").fillna(0)


def headline_numbers(df: DataFrame, start: Date | str, end: Date | str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_hotspots"),
        F.count_distinct(S.ENTITY).alias("n_entities"),
        F.avg("frp").alias("mean_frp"),
    ).withColumn("n_days", inclusive_days(F.lit(start).cast("date"), F.lit(end).cast("date")))


def fixed_sample(df: DataFrame, n: int = 5000, seed: int = 42, key: str = "event_id") -> DataFrame:
    """At most n rows, the same ones however the data is partitioned.

    A top-n by keyed hash: each task keeps n candidates, so nothing is fully sorted.
    """
    return (df.withColumn("_hash", hash_text(seed, F.col(key)))
            .orderBy("_hash", key).limit(n).drop("_hash"))


def markers(df: DataFrame) -> DataFrame:
    """Age in days against the newest row, opacity and radius for each detection."""
    newest = df.agg(F.max("acq_date")).scalar()
    power = F.when(F.col("frp") == 0, F.lit(5.0)).otherwise(F.coalesce("frp", F.lit(5.0)))
    return (df.withColumn("age_days", F.date_diff(newest, "acq_date"))
            .withColumns({"opacity": F.greatest(F.lit(0.4), F.lit(1.0) - F.col("age_days") / F.lit(30.0)),
                          "radius": F.greatest(F.lit(3.0), F.least(F.lit(12.0), power / F.lit(8.0)))}))


def newest_day_table(df: DataFrame, forecast: DataFrame) -> DataFrame:
    """Each forecast entity with its detections on the newest day of the whole set, 0 if none."""
    newest = df.agg(F.max("acq_date")).scalar()
    today = (df.filter(F.col("acq_date") == newest).groupBy(S.ENTITY)
             .agg(F.count(F.lit(1)).alias("today_count")))
    return forecast.join(today, S.ENTITY, "left").withColumn(
        "today_count", F.coalesce("today_count", F.lit(0).cast("long")))


def distinct_entities(df: DataFrame, entity: str = S.ENTITY) -> DataFrame:
    return df.select(entity).dropna().distinct()


def distinct_sketches(df: DataFrame, columns: list[str], by: str = "acq_date", precision: int = 12) -> DataFrame:
    """One mergeable sketch per day and column: `by`, then a `<column>_sketch` of at most 2 ** precision bytes or so.

    Nulls count for nothing. Days are stored once; any range of days is then counted from their sketches.
    """
    return df.groupBy(by).agg(*[F.hll_sketch_agg(c, precision).alias(f"{c}_sketch") for c in columns])


def merged_distinct(sketches: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Estimated distinct values over all sketches (of each group), with a standard error of 1.04 / sqrt(2 ** precision), 0 without any."""
    merged = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(f"n_{c}") for c in columns]
    return sketches.groupBy(*(by or [])).agg(*merged)
