"""Calendar expressions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_features(date: Column) -> dict[str, Column]:
    month = F.month(date)
    angle = F.lit(2 * pi) * month / F.lit(12)
    return {
        "month": month,
        "day_of_year": F.dayofyear(date),
        "month_sin": F.sin(angle),
        "month_cos": F.cos(angle),
    }


def inclusive_days(start: Column, end: Column) -> Column:
    return F.date_diff(end, start) + F.lit(1)
