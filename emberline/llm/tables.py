"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberline.session import new_folder

BATCH_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table and reads it back: what follows doesn't depend on its lineage or on executors that may be lost."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """From here on the session hands texts to Python in batches of about 4 MB, whatever their length; a single row may be larger."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
