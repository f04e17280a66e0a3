"""Join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], salt_by: list[str],
                     salts: int = 1) -> DataFrame:
    """Left join of many rows with a keyed table that may have a hot key.

    No broadcast hint: the right side can grow, so Spark broadcasts it only when its measured
    size is under the session's threshold. In a shuffled join Spark splits skewed keys; where a key is
    known to be hot, `salts` above 1 spreads each key by a hash of `salt_by` and repeats the keyed side.
    """
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(F.hash(*salt_by), F.lit(salts)))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = [*keys, "_salt"]
    return left.join(right, keys, "left").drop("_salt")
