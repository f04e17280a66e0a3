"""Time-aware split, training and batch scoring with boosted trees."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import schemas as S
from emberline.functions.hashing import uniform
from emberline.operators import boosting as B
from emberline.operators import metrics as M

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class TrainParams:
    """The reference settings. The penalties hold for the regressor."""
    learning_rate: float = 0.05
    n_estimators: int = 600
    max_depth: int = 8
    num_leaves: int = 31
    min_child_samples: int = 20
    reg_alpha: float = 0.1
    reg_lambda: float = 0.1


@dataclass(frozen=True)
class Model:
    """A table of tree nodes, what its outputs mean, and the classes they stand for (none for a regressor)."""
    nodes: DataFrame
    objective: str
    classes: tuple[int, ...] = ()


def add_split(df: DataFrame, holdout_days: int = 14, seed: int = 42, keys: tuple[str, ...] = (S.ENTITY, "date"),
              test_share: float = 0.2) -> DataFrame:
    """`is_test`: the last `holdout_days` days, by one cutoff for all entities.

    With no more distinct dates than that, a keyed hash sends one row in five to the test side.
    """
    span = df.agg(F.struct(F.max("date").alias("newest"), F.count_distinct("date").alias("n"))).scalar()
    late = F.col("date") > F.date_sub(span["newest"], holdout_days)
    drawn = uniform(seed, *[F.col(k) for k in keys]) < test_share
    return df.withColumn("is_test", F.when(span["n"] <= holdout_days, drawn).otherwise(late))


def time_split(df: DataFrame, holdout_days: int = 14) -> tuple[DataFrame, DataFrame]:
    marked = add_split(df, holdout_days)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def feature_names(df: DataFrame) -> list[str]:
    """Numeric columns that are neither ids nor targets."""
    skip = {S.ENTITY, "date", S.TARGET_COUNT, S.TARGET_CLASS, "is_test", "weight"}
    return [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, T.NumericType)]


def _settings(objective: str, params: TrainParams, penalised: bool) -> B.Settings:
    return B.Settings(objective, params.n_estimators, params.learning_rate, params.max_depth, params.num_leaves, params.min_child_samples,
                      params.reg_alpha if penalised else 0.0, params.reg_lambda if penalised else 0.0)


def train_regressor(train: DataFrame, params: TrainParams = TrainParams(), features: list[str] | None = None,
                    local_bytes: int = B.LOCAL_BYTES) -> Model:
    """Absolute-error boosting that starts from the median target. Rows without a target are left out."""
    features = features or feature_names(train)
    median = train.agg(F.percentile_approx(F.col(S.TARGET_COUNT).cast("double"), 0.5, 20_000)).scalar()
    start = train.sparkSession.range(1).select(median).first()[0]
    if start is None:
        raise ValueError("the training side holds no target")
    nodes = B.fit(train, features, S.TARGET_COUNT, None, _settings("l1", params, True), np.array([start]), local_bytes)
    return Model(nodes, "l1")


def train_classifier(train: DataFrame, params: TrainParams = TrainParams(), features: list[str] | None = None,
                     local_bytes: int = B.LOCAL_BYTES) -> Model:
    """Softmax boosting with balanced class weights, logistic for two classes; one class alone is an error."""
    features = features or feature_names(train)
    # At most one row per risk class comes back.
    weights = {r[S.TARGET_CLASS]: r["weight"] for r in M.class_weights(train, S.TARGET_CLASS).collect()}
    if len(weights) < 2:
        raise ValueError("the training side holds fewer than two classes")
    classes = tuple(sorted(weights))
    place, by_class = F.lit(None).cast("int"), F.lit(None).cast("double")
    for i, level in enumerate(classes):
        place = F.when(F.col(S.TARGET_CLASS) == level, i).otherwise(place)
        by_class = F.when(F.col(S.TARGET_CLASS) == level, F.lit(weights[level])).otherwise(by_class)
    weighted = train.withColumns({"_place": place, "_weight": by_class})
    # Balanced classes weigh the same, so all outputs start alike.
    objective, start = ("binary", np.zeros(1)) if len(classes) == 2 else ("softmax", np.full(len(classes), -math.log(len(classes))))
    nodes = B.fit(weighted, features, "_place", "_weight", _settings(objective, params, False), start, local_bytes)
    return Model(nodes, objective, classes)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Batch scoring: one pass over all rows; adds `prediction`, for a classifier the likeliest class."""
    out = B.scores(df, model.nodes, "_scores")
    raw = F.col("_scores")
    if model.objective == "l1":
        prediction = raw[0]
    elif model.objective == "binary":
        prediction = F.when(raw[0] > 0, F.lit(float(model.classes[1]))).otherwise(F.lit(float(model.classes[0])))
    else:
        prediction = F.element_at(F.array(*[F.lit(float(c)) for c in model.classes]), F.array_position(raw, F.array_max(raw)).cast("int"))
    return out.withColumn("prediction", prediction).drop("_scores")


def save_model(model: Model, folder: str, run_id: str) -> None:
    """Appends the model's nodes to a table of models, under the id of its training run."""
    classes = F.array(*[F.lit(c) for c in model.classes]).cast("array<int>")
    model.nodes.select(F.lit(run_id).alias("run_id"), F.lit(model.objective).alias("objective"), classes.alias("classes"), "*").coalesce(1).write.mode("append").parquet(folder)


def load_model(models: DataFrame, run_id: str) -> Model:
    mine = models.where(F.col("run_id") == run_id)
    head = mine.select("objective", "classes").limit(1).collect()
    if not head:
        raise ValueError(f"no model of run {run_id!r}")
    return Model(mine.drop("run_id", "objective", "classes"), head[0]["objective"], tuple(head[0]["classes"]))


def staged_model(models: DataFrame, versions: DataFrame, name: str, stage: str = "Production") -> Model:
    """The registered model of a stage; of several versions there the highest."""
    current = (versions.where((F.col("name") == name) & (F.col("stage") == stage))
               .agg(F.max_by("run_id", F.col("version").cast("int")).alias("run_id")).first()["run_id"])
    if current is None:
        raise ValueError(f"no version of {name!r} in stage {stage}")
    return load_model(models, current)


def score_foreign(df: DataFrame, predict: Callable[[pd.DataFrame], pd.Series] | None = None,
                  features: list[str] = S.FEATURES, load: Callable[[], Callable[[pd.DataFrame], pd.Series]] | None = None) -> DataFrame:
    """Scores from a model outside Spark, in Arrow batches. `load` returns the model's function, once per task.

    Where a batch fails its rows are scored one by one, and only those that fail themselves score null, so
    the result doesn't depend on the size of batches.
    """
    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load() if load else predict

        def alone(row: pd.DataFrame) -> float | None:
            try:
                return float(pd.Series(model(row)).iloc[0])
            except Exception as error:  # noqa: BLE001 - a failed score is a null, not a failed job
                LOG.warning("a row could not be scored: %s", error)
                return None

        for batch in batches:
            try:
                out = pd.Series(model(batch), index=batch.index, dtype="float64")
            except Exception:  # noqa: BLE001 - tried again row by row
                out = pd.Series([alone(batch.iloc[[i]]) for i in range(len(batch))], index=batch.index, dtype="float64")
            yield out
    return df.withColumn("prediction", run(F.struct(*[F.col(f) for f in features])))


def regressor_report(scored: DataFrame, features: list[str]) -> DataFrame:
    out = M.regression_metrics(scored, S.TARGET_COUNT, "prediction")
    return out.withColumn("n_features", F.lit(len(features)))


def classifier_report(scored: DataFrame) -> DataFrame:
    return M.classification_metrics(M.class_report(M.confusion(scored, S.TARGET_CLASS, "prediction")))
