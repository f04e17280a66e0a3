"""Global order without a global task: range partitions, a window in each, and one offset per partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Stores the rows in global order, with the number of their partition in `__part`. Meant for narrow rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    return stored(ranged, name)


def running_total(df: DataFrame, order: list[Column], value: Column, into: str, name: str) -> DataFrame:
    """Adds the sum of `value` over all rows that come earlier in the order."""
    ordered = in_order(df.withColumn("__value", value.cast("long")), order, name)
    parts = ordered.groupBy("__part").agg(F.sum("__value").alias("__sum"))
    # One row per partition: their number doesn't grow with the rows of a partition.
    before = parts.select(F.col("__part").alias("__p"), (F.sum("__sum").over(Window.orderBy("__part")) - F.col("__sum")).alias("__before"))
    inside = F.sum("__value").over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return (ordered.withColumn("__inside", F.coalesce(inside, F.lit(0)))
            .join(F.broadcast(before), F.col("__part") == F.col("__p"))
            .withColumn(into, F.col("__before") + F.col("__inside"))
            .drop("__value", "__part", "__p", "__before", "__inside"))


def numbered(df: DataFrame, order: list[Column], into: str, name: str) -> DataFrame:
    """Adds each row's place in the order, from 0."""
    return running_total(df, order, F.lit(1), into, name)
