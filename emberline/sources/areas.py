"""The area dimension: load, selection, box checks and the fetch plan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline import schemas as S


def default_areas(spark: SparkSession) -> DataFrame:
    """The configured areas; their list order is their priority."""
    rows = [(i, *area) for i, area in enumerate(S.AREAS, 1)]
    return spark.createDataFrame(rows, S.AREA_SCHEMA)


def select_areas(areas: DataFrame, requested: list[str], ignore_case: bool = True) -> DataFrame:
    """All areas, or the requested ids; an unknown id is an error.

    The check looks up the requested ids only, so what reaches the driver is no longer than
    the request.
    """
    if len(requested) == 1 and (requested[0].lower() if ignore_case else requested[0]) == "all":
        return areas
    fold = F.lower if ignore_case else (lambda c: c)
    wanted = {r.lower() for r in requested} if ignore_case else set(requested)
    chosen = areas.filter(fold(F.col(S.ENTITY)).isin(sorted(wanted)))
    known = {r[0] for r in chosen.select(fold(F.col(S.ENTITY))).distinct().collect()}
    if wanted - known:
        raise ValueError(f"unknown area ids: {sorted(wanted - known)}")
    return chosen


def valid_box() -> Column:
    """Minimum strictly below maximum, and all four bounds on the globe."""
    return F.coalesce(
        (F.col("lat_min") >= -90) & (F.col("lat_min") < F.col("lat_max")) & (F.col("lat_max") <= 90)
        & (F.col("lon_min") >= -180) & (F.col("lon_min") < F.col("lon_max")) & (F.col("lon_max") <= 180),
        F.lit(False))


def split_by_validity(areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    return areas.filter(valid_box()), areas.filter(~valid_box())


def add_centroid(areas: DataFrame) -> DataFrame:
    return areas.withColumns({"lat": (F.col("lat_min") + F.col("lat_max")) / 2,
                              "lon": (F.col("lon_min") + F.col("lon_max")) / 2})


def coordinate_text(c: Column) -> Column:
    return F.format_string("%.4f", c)


def check_window(start: date, end: date, today: date | None = None) -> None:
    today = today or date.today()
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    if end > today + timedelta(days=1):
        raise ValueError(f"end {end} is in the future")


def chunk_windows(windows: DataFrame, max_days: int = 5, today: Column | None = None,
                  retention_days: int = 60) -> DataFrame:
    """Inclusive [start, end] per row to chunks of at most `max_days`.

    `days` counts both ends; `old_start` marks windows that start before the retention of the
    near-real-time feed.
    """
    starts = F.sequence("start", "end", F.make_dt_interval(F.lit(max_days)))
    return (windows
            .withColumn("old_start", F.date_diff(today if today is not None else F.current_date(), "start")
                        > retention_days)
            .withColumn("chunk_start", F.explode(starts))
            .withColumn("chunk_end", F.least(F.date_add("chunk_start", max_days - 1), F.col("end")))
            .withColumn("days", F.date_diff("chunk_end", "chunk_start") + 1))


def fetch_plan(spark: SparkSession, areas: DataFrame, start: date, end: date, max_days: int = 5) -> DataFrame:
    """One row per area and chunk, with the centroid as URL text."""
    check_window(start, end)
    windows = areas.withColumns({"start": F.lit(start), "end": F.lit(end)})
    chunks = add_centroid(chunk_windows(windows, max_days))
    return chunks.withColumns({"lat_text": coordinate_text(F.col("lat")), "lon_text": coordinate_text(F.col("lon"))})
