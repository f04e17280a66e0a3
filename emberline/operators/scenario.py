"""What-if shifts of the feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.clean import clip
from emberline.functions.hashing import uniform


def _apply(df: DataFrame, changes: dict[str, Callable[[Column], Column]]) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c, fn in changes.items() if c in df.columns})


def _scale(columns: list[str], factor: float) -> dict[str, Callable[[Column], Column]]:
    return {c: (lambda v: v * F.lit(factor)) for c in columns}


def _shift(amount: float) -> Callable[[Column], Column]:
    return lambda v: v + F.lit(amount)


# The shifts and factors of the three scenarios below, at a magnitude of 1.

def drought(df: DataFrame, magnitude: float = 1.0) -> DataFrame:
    """A long dry spell: forecasts should rise. Dry days round half to even."""
    return _apply(df, {
        **_scale(["precipitation_sum"], max(0.0, 1 - 0.7 * magnitude)),
        **_scale(["relative_humidity_2m_mean"], max(0.0, 1 - 0.25 * magnitude)),
        "temperature_2m_max": _shift(3.5 * magnitude),
        "temperature_2m_min": _shift(2.5 * magnitude),
        "days_since_rain": lambda v: F.bround(v.cast("double") + F.lit(14.0 * magnitude)).cast("long"),
        **_scale(S.FIRE, 1 + 0.35 * magnitude),
        **_scale(S.ROLLING, 1 + 0.25 * magnitude),
    })


def wet(df: DataFrame, magnitude: float = 1.0) -> DataFrame:
    """Heavy rain: forecasts should fall."""
    return _apply(df, {
        "precipitation_sum": _shift(25.0 * magnitude),
        "relative_humidity_2m_mean": _shift(15.0 * magnitude),
        "temperature_2m_max": _shift(-2.5 * magnitude),
        "temperature_2m_min": _shift(-1.5 * magnitude),
        "days_since_rain": lambda v: F.lit(0).cast("long"),
        **_scale(S.FIRE, max(0.0, 1 - 0.5 * magnitude)),
        **_scale(S.ROLLING, max(0.0, 1 - 0.4 * magnitude)),
    })


def mixed(df: DataFrame, magnitude: float = 1.0, seed: int = 42, keys: tuple[str, ...] = (S.ENTITY, "date")) -> DataFrame:
    """Every weather and fire value times 1 + U(-0.15 m, 0.15 m), drawn per row and column."""
    spread = 0.15 * magnitude

    def noise(column: str) -> Callable[[Column], Column]:
        u = uniform(seed, *[F.col(k) for k in keys], F.lit(column))
        return lambda v: v * (F.lit(1 - spread) + F.lit(2 * spread) * u)
    return _apply(df, {c: noise(c) for c in S.SHIFTED_WEATHER + S.FIRE + S.ROLLING})


SCENARIOS: dict[str, Callable[..., DataFrame]] = {"drought": drought, "wet": wet, "mixed": mixed}


def clamp_physical(df: DataFrame) -> DataFrame:
    bounds = {c: (lambda v, lo=lo, hi=hi: clip(v, lo, hi)) for c, (lo, hi) in S.PHYSICAL_BOUNDS.items()}
    floor = {c: (lambda v: clip(v, low=0.0)) for c in S.FIRE + S.ROLLING}
    return _apply(df, {**bounds, **floor})


def run_scenario(df: DataFrame, name: str, magnitude: float = 1.0, **options) -> DataFrame:
    return clamp_physical(SCENARIOS[name](df, magnitude, **options))


def summarize_shift(df: DataFrame, shift: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """Mean per column before and after a shift, and the change in percent (0 when the base is near 0).

    The shift works row by row, so both sides are averaged in one pass over the table.
    """
    present = [c for c in columns if c in df.columns]
    both = shift(df.withColumns({f"_before_{c}": F.col(c) for c in present}))
    means = both.agg(*[F.struct(F.lit(c).alias("column"), F.avg(f"_before_{c}").alias("before"), F.avg(c).alias("after")).alias(f"_{i}")
                       for i, c in enumerate(present)])
    rows = means.select(F.inline(F.array(*[f"_{i}" for i in range(len(present))])))
    return rows.withColumn("delta_pct", F.when(
        F.abs("before") > 1e-9, (F.col("after") - F.col("before")) / F.col("before") * 100).otherwise(F.lit(0.0)))
