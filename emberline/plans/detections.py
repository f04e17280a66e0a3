"""Raw detections of several areas to cleaned ones, ranked by the area table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators.cleaning import clean_detections


def clean_by_area(raw: DataFrame, areas: DataFrame, tie_break: list[Column], offset_hours: int = S.UTC_OFFSET_HOURS,
                  entity: str = S.ENTITY) -> DataFrame:
    """`clean_detections` where a detection that several areas report stays with the one of the lowest `priority`.

    An area with several boxes counts with its lowest priority. Areas that the table lacks, and rows without an area, come
    last. Equal priorities are settled by `tie_break`, which must be total. The area table joins by its size at run time:
    no hint, since nothing bounds it.
    """
    ranks = areas.groupBy(F.col(entity).alias("_area")).agg(F.min("priority").alias("_priority"))
    ranked = raw.join(ranks, F.col(entity) == F.col("_area"), "left").drop("_area")
    return clean_detections(ranked, [F.asc_nulls_last("_priority"), *tie_break], offset_hours)
