"""Documents that another table names by id, without moving the others.

A bitmap of hashed ids of a fixed size (2^22 bits) parts the documents where they are read: those whose bit isn't
set are surely not named and stay where they are; the few others are joined exactly. So what is shuffled grows with
the other table, up to all documents where it names most of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 22


def parted(documents: DataFrame, known: DataFrame, by: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The documents that are surely not named by `known`, and the others. A null in the column `by` is not named."""
    place = F.pmod(F.xxhash64(by), F.lit(1 << BITS))
    parts = (known.where(F.col(by).isNotNull()).select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    bitmap = np.zeros(1 << BITS, bool)
    for part in parts:
        bits = np.unpackbits(np.frombuffer(part["bits"], np.uint8), bitorder="little")
        bitmap[(part["k"] - 1) * len(bits):part["k"] * len(bits)] = bits
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(bitmap))
    given = documents.withColumn("__place", F.when(F.col(by).isNotNull(), place).otherwise(-1))

    def side(wanted: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bitmap = np.append(np.unpackbits(shared.value).astype(bool), False)  # the last place is that of null ids
            for batch in batches:
                yield batch.filter(pa.array(bitmap[batch.column(batch.num_columns - 1).to_numpy()] == wanted))
        return given.mapInArrow(pick, given.schema).drop("__place")

    return side(False), side(True)


def named(documents: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text and the columns of `known`, which has one row per doc_id, for the documents in it.
    Null ids match nothing; repeated documents all stay."""
    _, some = parted(documents.select("doc_id", "text"), known)
    return some.join(known.where("doc_id is not null").hint("shuffle_hash"), "doc_id")


def labelled(documents: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text and the label of every document that has one; of several labels of one id the largest holds."""
    return named(documents, labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label)))
