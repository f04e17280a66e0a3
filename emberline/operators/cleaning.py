"""Detection and weather cleaning, and the two de-duplications."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions import clean


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Drop rows with a null in a required column; runs before any coercion."""
    return df.dropna(subset=required)


def coerce_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns to double, bad values to null; ones that are numbers already skip the text step."""
    text = {c for c, t in df.dtypes if t == "string"}
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: clean.clean_double(F.col(c)) if c in text else clean.drop_nan(F.col(c).cast("double"))
                           for c in present})


def in_domain(df: DataFrame) -> DataFrame:
    """Coordinates on the globe and fire power not negative; a null frp goes too."""
    return df.filter(F.col("latitude").between(-90, 90)
                     & F.col("longitude").between(-180, 180)
                     & (F.col("frp") >= 0))


def add_acquisition_times(df: DataFrame, offset_hours: int = S.UTC_OFFSET_HOURS) -> DataFrame:
    """UTC timestamp from date and HHMM, local timestamp and local date; unreadable times drop."""
    utc = df.withColumn("acq_datetime_utc", clean.utc_timestamp(F.col("acq_date"), F.col("acq_time")))
    return add_local_times(utc.dropna(subset=["acq_datetime_utc"]), offset_hours)


def add_local_times(df: DataFrame, offset_hours: int = S.UTC_OFFSET_HOURS) -> DataFrame:
    local = clean.shift_hours(F.col("acq_datetime_utc"), offset_hours)
    return df.withColumns({"acq_datetime_wib": local, "acq_date_wib": F.to_date(local)})


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in `order`, which must be total.

    Spark turns `row_number() = 1` into a per-task limit before the shuffle, so a key that
    holds a third of all rows sends one row per map task, not its whole group.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedup_detections(df: DataFrame, order: list[Column]) -> DataFrame:
    keys = ["latitude", "longitude", "acq_datetime_utc"]
    if "satellite" in df.columns:
        keys.append("satellite")
    return keep_first(df, keys, order)


def clean_detections(df: DataFrame, order: list[Column], offset_hours: int = S.UTC_OFFSET_HOURS,
                     watch: Callable[[str, DataFrame], DataFrame] = lambda step, rows: rows) -> DataFrame:
    """Raw text detections to typed, valid, de-duplicated ones.

    `order` ranks duplicates: area priority first, then anything that makes it total. `watch` sees the rows after each step.
    """
    require_columns(df, S.DETECTION_REQUIRED, "detections")
    whole = watch("n_complete", drop_incomplete(watch("n_raw", df), S.DETECTION_REQUIRED))
    out = coerce_numbers(whole, ["latitude", "longitude", "frp"])
    if "confidence" in df.columns:
        out = out.withColumn("confidence", clean.clean_text(F.col("confidence")))
    timed = watch("n_timed", add_acquisition_times(watch("n_valid", in_domain(out)), offset_hours))
    return project_detections(watch("n_distinct", dedup_detections(timed, order)))


def clean_and_count(df: DataFrame, order: list[Column],
                    offset_hours: int = S.UTC_OFFSET_HOURS) -> tuple[DataFrame, dict[str, Observation]]:
    """`clean_detections` whose first action also counts the rows each step leaves, without a pass of its own.

    Read the counts with `counts` after that action. They are for reports: a task that runs again after a lost executor
    may be counted twice, where `cleaning_counts` is exact.
    """
    seen: dict[str, Observation] = {}

    def watch(step: str, rows: DataFrame) -> DataFrame:
        seen[step] = Observation(f"{step}-{uuid.uuid4().hex}")
        return rows.observe(seen[step], F.count(F.lit(1)).alias(step))
    return clean_detections(df, order, offset_hours, watch), seen


def counts(seen: dict[str, Observation]) -> dict[str, int]:
    """Rows after each step, in order; waits for the first action on the watched table."""
    def rows(step: str, observed: Observation) -> int:
        try:
            return observed.get[step]
        except Py4JJavaError as error:
            # A step that Spark knows to be empty is cut from the plan and reports a row without columns.
            if "assertion failed" not in str(error.java_exception):
                raise
            return 0
    return {step: rows(step, observed) for step, observed in seen.items()}


def cleaning_counts(df: DataFrame) -> DataFrame:
    """How many rows each step of `clean_detections` leaves: one row, one pass over the raw table."""
    require_columns(df, S.DETECTION_REQUIRED, "detections")
    complete = F.lit(True)
    for c in S.DETECTION_REQUIRED:
        complete = complete & F.col(c).isNotNull()
    typed = coerce_numbers(df.withColumn("_complete", complete), ["latitude", "longitude", "frp"])
    valid = (F.col("_complete") & F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180) & (F.col("frp") >= 0))
    timed = typed.withColumn("_valid", F.coalesce(valid, F.lit(False))).withColumn(
        "acq_datetime_utc", F.when(F.col("_valid"), clean.utc_timestamp(F.col("acq_date"), F.col("acq_time"))))
    keys = [c for c in ("latitude", "longitude", "acq_datetime_utc", "satellite") if c in df.columns or c == "acq_datetime_utc"]
    known = F.col("acq_datetime_utc").isNotNull()
    return timed.agg(
        F.count(F.lit(1)).alias("n_raw"), F.count_if("_complete").alias("n_complete"), F.count_if("_valid").alias("n_valid"),
        F.count_if(known).alias("n_timed"), F.count_distinct(F.when(known, F.struct(*keys))).alias("n_distinct"))


def project_detections(df: DataFrame) -> DataFrame:
    kept = [c for c in S.DETECTION_KEPT if c in df.columns]
    return df.select(*kept, S.ENTITY, "acq_datetime_utc", "acq_datetime_wib", "acq_date_wib")


def parse_weather(df: DataFrame) -> DataFrame:
    """Date text to date (bad dates drop) and the weather columns to double."""
    require_columns(df, S.WEATHER_REQUIRED, "weather")
    # A time part, if any, is cut off: only the day matters.
    dated = df.withColumn("date", F.substring(F.trim(F.col("date").cast("string")), 1, 10).try_cast("date"))
    return coerce_numbers(dated.dropna(subset=["date"]), S.WEATHER)


def dedup_weather(df: DataFrame, tie_break: list[Column]) -> DataFrame:
    """Newest snapshot per entity and day; a row without a stamp counts as newest."""
    order = [F.desc_nulls_first("fetched_at_utc")] if "fetched_at_utc" in df.columns else []
    return keep_first(df, [S.ENTITY, "date"], order + tie_break)


def clean_weather(df: DataFrame, tie_break: list[Column]) -> DataFrame:
    return dedup_weather(parse_weather(df), tie_break)
