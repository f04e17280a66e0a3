"""Next-day targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.risk import risk_level
from emberline.operators.windows import target_column


def add_targets(daily: DataFrame, horizon: int = S.HORIZON, entity: str = S.ENTITY) -> DataFrame:
    """Count of the next row and its risk class; -1 marks a row without a next one."""
    return daily.withColumn(S.TARGET_COUNT, target_column(horizon, entity)).withColumn(
        S.TARGET_CLASS, F.coalesce(risk_level(F.col(S.TARGET_COUNT)), F.lit(-1)))


def drop_unlabelled(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[S.TARGET_COUNT])
