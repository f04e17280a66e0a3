from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import learning as N
from emberline.plans import scoring as G

SHORT = N.TrainParams(n_estimators=20, max_depth=3, min_child_samples=1)


@pytest.fixture(scope="module")
def table(spark):
    """Tomorrow's count follows a feature that is missing on some rows."""
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 60).cast("int"))
    count = (F.col("id") % 2) * 20
    return spark.range(600).select(
        (F.col("id") / 60).cast("int").cast("string").alias("province_id"), day.alias("date"), count.alias("hotspot_count"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 5).cast("double").alias("frp_mean"), F.lit("text").alias("note"),
        count.cast("double").alias("hotspot_count_tomorrow"), (F.when(count > 10, 2).otherwise(0)).alias("risk_level")).cache()


def test_split_is_by_time_or_by_hash(spark, table):
    train, test = N.time_split(table)
    assert test.agg(F.min("date")).first()[0] == dt.date(2024, 2, 16) and test.count() == 140 and train.count() == 460
    share = N.add_split(table, 60).filter("is_test").count() / 600
    assert 0.12 < share < 0.28


def test_regressor_learns_and_scores_with_nulls(spark, table):
    assert N.feature_names(table) == ["hotspot_count", "frp_mean"]
    model, report = G.fit_and_report(table, SHORT)
    r = report.first()
    assert r["rmse"] < 10 and r["n_rows"] == 140 and r["n_features"] == 2
    scored = G.score_latest(model, table)
    assert scored.count() == 10 and scored.filter("prediction_count is null").isEmpty()
    kept = N.score(model, table)
    assert kept.filter("frp_mean is null").count() == table.filter("frp_mean is null").count()


def test_classifier_needs_two_classes(spark, table):
    train, test = N.time_split(table)
    r = N.classifier_report(N.score(N.train_classifier(train, SHORT), test)).first()
    assert r["f1_macro"] > 0.9 and r["recall_bahaya"] > 0.9
    with pytest.raises(ValueError, match="two classes"):
        N.train_classifier(train.filter("risk_level = 2"), SHORT)


def test_foreign_model_failure_is_null(spark, table):
    def predict(batch):
        if (batch["hotspot_count"] > 0).any():
            raise RuntimeError("no")
        return batch["hotspot_count"] + 1.0
    whole = N.score_foreign(table, predict, ["hotspot_count"])
    assert whole.filter((F.col("hotspot_count") > 0) != F.col("prediction").isNull()).isEmpty()
    loaded = N.score_foreign(table, features=["hotspot_count"], load=lambda: predict)
    assert loaded.filter("prediction = 1").count() == table.filter("hotspot_count = 0").count()
    low = table.filter("hotspot_count = 0")
    assert N.score_foreign(low, predict, ["hotspot_count"]).filter("prediction = 1").count() == low.count()
    assert N.score_foreign(table.filter("hotspot_count > 0"), predict, ["hotspot_count"]).filter("prediction is not null").isEmpty()
