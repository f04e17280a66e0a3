"""Class and rank expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberline import schemas as S

# Confidence letters and the filter's level names.
CONFIDENCE_RANK = {"l": 0, "n": 1, "h": 2}
LEVEL_RANK = {"low": 0, "nominal": 1, "high": 2}


def risk_level(count: Column) -> Column:
    """0 up to AMAN_MAX, 1 up to WASPADA_MAX, else 2; null stays null."""
    return (F.when(count.isNull(), F.lit(None).cast("int"))
            .when(count <= S.AMAN_MAX, F.lit(0))
            .when(count <= S.WASPADA_MAX, F.lit(1))
            .otherwise(F.lit(2)))


def risk_label(level: Column) -> Column:
    out = F.lit(None).cast("string")
    for value, label in S.RISK_LABELS.items():
        out = F.when(level == value, F.lit(label)).otherwise(out)
    return out


def confidence_rank(confidence: Column) -> Column:
    """Unknown or missing confidence counts as low."""
    rank = F.lit(0)
    for letter, value in CONFIDENCE_RANK.items():
        if value:
            rank = F.when(confidence == letter, F.lit(value)).otherwise(rank)
    return rank


def status_class(code: Column) -> Column:
    """HTTP status code to 2xx, 3xx, 4xx, 5xx or other."""
    hundred = F.floor(code / 100)
    return F.when(hundred.between(2, 5), F.concat(hundred.cast("string"), F.lit("xx"))).otherwise("other")
