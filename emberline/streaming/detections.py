"""Detection streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S

KEYS = ["latitude", "longitude", "acq_datetime_utc", "satellite"]


def dedup(stream: DataFrame, delay: str = "1 hour", salts: int = 8) -> DataFrame:
    """One of each set of duplicates that arrive within the delay; state older than it is dropped.

    Which duplicate stays is open: the batch form ranks them. A first round spreads the copies
    of one detection over `salts` tasks and lets one through from each, so the second round,
    keyed by the detection alone, never meets a hot key. The salt is the input partition, which
    a retried task keeps.
    """
    timed = stream.withWatermark("acq_datetime_utc", delay)
    if salts <= 1:
        return timed.dropDuplicatesWithinWatermark(KEYS)
    salted = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    thinned = salted.dropDuplicatesWithinWatermark([*KEYS, "_salt"]).drop("_salt")
    return thinned.dropDuplicatesWithinWatermark(KEYS)


def dedup_first(stream: DataFrame, order: list[Column], delay: str = "1 hour") -> DataFrame:
    """Of each set of duplicates the first in `order` (ascending, nulls first, total), as the batch form chooses.

    A detection's time is part of its key, so a set is complete once the watermark has passed that time: then its row
    comes out, once. Copies later than the delay are dropped, rows without a time too. The choice is an aggregate that is
    taken in each task first, so a key with very many copies sends one row per task, and the state holds one row per key.
    """
    timed = stream.filter(F.col("acq_datetime_utc").isNotNull()).withWatermark("acq_datetime_utc", delay)
    rest = [c for c in stream.columns if c not in KEYS]
    first = timed.groupBy(*KEYS).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*[F.col(c) if c in KEYS else F.col("_first")[c].alias(c) for c in stream.columns])


def daily_counts(stream: DataFrame, delay: str = "1 hour", offset_hours: int = 0, entity: str = S.ENTITY) -> DataFrame:
    """Counts per entity and day, each day once, after the watermark has passed its end.

    The offset moves day borders to local midnight.
    """
    day = F.window("acq_datetime_utc", "1 day", startTime=f"{(24 - offset_hours) % 24} hours")
    return (stream.withWatermark("acq_datetime_utc", delay)
            .groupBy(day, F.col(entity))
            .agg(F.count(F.lit(1)).alias("hotspot_count"))
            .select(F.to_date(F.col("window.start") + F.make_dt_interval(hours=F.lit(offset_hours))).alias("date"),
                    F.col(entity), "hotspot_count"))
