"""Cumulative histograms and the quantile read off one (public Prometheus rule)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_counts(value: Column, bounds: list[float], prefix: str) -> list[Column]:
    """One cumulative count per upper bound, plus the total of all numeric values.

    All counts come from a single aggregation, so a shuffle moves one row per group and map task.
    """
    counts = [F.count_if(value <= F.lit(b)).alias(f"{prefix}_{i}") for i, b in enumerate(bounds)]
    return counts + [F.count(value).alias(f"{prefix}_total")]


def bucket_names(bounds: list[float], prefix: str) -> list[str]:
    return [f"{prefix}_{i}" for i in range(len(bounds))] + [f"{prefix}_total"]


def bucket_quantile(q: float, bounds: list[float], prefix: str) -> Column:
    """Linear interpolation inside the first bucket whose cumulative count reaches q * total.

    Ranks past the last finite bound give that bound; an empty histogram gives null. At q = 0 the rank is 0, and
    the first bucket that holds a value is the one interpolated in.
    """
    total = F.col(f"{prefix}_total")
    rank = F.lit(q) * total
    out = F.when(total == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        here = F.col(f"{prefix}_{i}")
        if i == 0:
            value = F.lit(bound) if bound <= 0 else F.lit(bound) * rank / F.nullif(here, F.lit(0))
        else:
            below = F.col(f"{prefix}_{i - 1}")
            value = F.lit(bounds[i - 1]) + F.lit(bound - bounds[i - 1]) * ((rank - below) / F.nullif(here - below, F.lit(0)))
        out = out.when((here >= rank) & (here > 0), value)
    return out.otherwise(F.lit(bounds[-1]))


def bucket_upper_bound(value: Column, bounds: list[float]) -> Column:
    """The smallest bound that holds the value, as double; infinity past the last one."""
    out = F.lit(float("inf"))
    for bound in reversed(bounds):
        out = F.when(value <= F.lit(bound), F.lit(bound)).otherwise(out)
    return F.when(value.isNotNull(), out)
