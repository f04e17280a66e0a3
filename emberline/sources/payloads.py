"""Weather service payloads to daily rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S


def weather_rows(payloads: DataFrame, payload: str = "payload", fetched_at: str | None = None) -> DataFrame:
    """Parallel arrays under `daily` to one row per day; an absent variable is null.

    A payload without `daily.time` fails the job. `fetched_at` names the stamp column of a
    forecast payload; archive payloads have none.
    """
    daily = F.from_json(F.col(payload), S.WEATHER_PAYLOAD)["daily"]
    parsed = payloads.withColumn("_d", daily)
    times = F.when(F.coalesce(F.size("_d.time"), F.lit(0)) > 0, F.col("_d.time")).otherwise(
        F.raise_error(F.concat(F.lit("payload without daily.time for "), F.col(S.ENTITY))).cast("array<string>"))
    empty = F.array_repeat(F.lit(None).cast("double"), F.size("_d.time"))
    zipped = F.arrays_zip(times.alias("date"), *[F.coalesce(F.col(f"_d.{v}"), empty).alias(v) for v in S.WEATHER])
    stamp = [F.col(fetched_at).alias("fetched_at_utc")] if fetched_at else []
    return parsed.select(S.ENTITY, *stamp, F.inline(zipped)).withColumn("date", F.col("date").try_cast("date"))
