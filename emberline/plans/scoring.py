"""Training, evaluation and batch scoring flows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberline.operators import learning as N
from emberline.operators import scoring as P
from emberline.operators import windows as W


def fit_and_report(table: DataFrame, params: N.TrainParams = N.TrainParams(), holdout_days: int = 14
                   ) -> tuple[N.Model, DataFrame]:
    """Regressor on the older days, with its metrics on the held-out ones."""
    train, test = N.time_split(table, holdout_days)
    model = N.train_regressor(train, params)
    return model, N.regressor_report(N.score(model, test), N.feature_names(table))


def score_latest(model: N.Model, features: DataFrame) -> DataFrame:
    """The newest feature row per entity, scored and given a risk class."""
    return P.prediction_rows(N.score(model, W.latest_per_entity(features)))
