"""Cleaned detections and weather to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberline import schemas as S
from emberline.operators import daily as D
from emberline.operators import targets as T
from emberline.operators import windows as W


def daily_features(detections: DataFrame, weather: DataFrame | None = None, dense: bool = False,
                   entity: str = S.ENTITY) -> DataFrame:
    """All 27 features per entity and day, with no target: the frame to score.

    Weather joins the daily rows, not the detections. `dense` counts calendar days instead of
    observed ones.
    """
    table = D.aggregate_daily(detections, entity=entity)
    if dense:
        table = D.fill_calendar(table, entity)
    if weather is not None:
        table = D.join_daily_weather(table.drop(*S.WEATHER), weather, entity)
    table = W.add_calendar(table)
    table = W.add_lags(W.add_rolling(table, entity=entity), entity=entity)
    return W.add_days_since_rain(table, entity=entity)


def training_table(detections: DataFrame, weather: DataFrame | None = None, dense: bool = False,
                   horizon: int = S.HORIZON, entity: str = S.ENTITY) -> DataFrame:
    """Features with next-day targets; each entity's last day has none and drops."""
    features = daily_features(detections, weather, dense, entity)
    return T.drop_unlabelled(T.add_targets(features, horizon, entity))
