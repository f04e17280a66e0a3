"""Model metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline import schemas as S

RISK_CLASSES = tuple(S.RISK_LABELS)


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.groupBy(*by).agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
                               F.count(F.lit(1)).alias("n_rows"))


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
                      ).agg(F.count(F.lit(1)).alias("n"))


def class_report(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class seen in truth or prediction; 0 for 0/0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0).cast("long"))
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("actual"), none.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), none.alias("tp"), none.alias("actual"), F.col("n").alias("predicted")))
    sums = (table.select(*by, F.inline(sides)).groupBy(*by, "class")
            .agg(*[F.sum(c).alias(c) for c in ("tp", "actual", "predicted")]))

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
    return sums.select(
        *by, "class", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("actual")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("actual") + F.col("predicted")).alias("f1"),
        F.col("actual").alias("support"))


def classification_metrics(report: DataFrame, alarm_class: int = 2, by: Sequence[str] = ()) -> DataFrame:
    return report.groupBy(*by).agg(
        F.avg("f1").alias("f1_macro"),
        F.coalesce(F.max(F.when(F.col("class") == alarm_class, F.col("recall"))), F.lit(0.0)).alias("recall_bahaya"),
        F.sum("support").alias("n_rows"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def class_weights(df: DataFrame, label: str, classes: Sequence[int] = RISK_CLASSES) -> DataFrame:
    """Balanced weight per class: n / (k * n_class). One row for each of the fixed classes seen."""
    every_class = Window.partitionBy()
    counts = df.filter(F.col(label).isin(list(classes))).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    mean = F.sum("_n").over(every_class) / F.count(F.lit(1)).over(every_class)
    return counts.select(label, (mean / F.col("_n")).alias("weight"))


def with_class_weights(df: DataFrame, label: str, classes: Sequence[int] = RISK_CLASSES) -> DataFrame:
    """Weights attached to every row. Safe to broadcast: at most len(classes) rows."""
    return df.join(F.broadcast(class_weights(df, label, classes)), label, "left")
