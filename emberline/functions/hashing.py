"""Seeded pseudo-random numbers from row keys.

A number depends only on the row's key and the seed, so it survives re-partitioning, retries
and lost executors, and any engine with md5 gives the same one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_text(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))


def uniform(seed: int, *keys: Column) -> Column:
    """A double in [0, 1) from the first 32 bits of the key's md5."""
    return F.conv(F.substring(hash_text(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
