"""Running a stream over what has arrived, into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.operators.alerts import trigger_rows

BATCHES = "_batches"
BATCHES_SCHEMA = "stream string, batch long"


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that has arrived and append finished rows to parquet.

    The file sink and the checkpoint make it exactly-once across restarts; both paths belong in
    a folder that all executors share.
    """
    (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def written_batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches that count: `stream` and `batch`, one row each (none before the first)."""
    try:
        return spark.read.schema(BATCHES_SCHEMA).json(f"{path}/{BATCHES}").distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BATCHES_SCHEMA)


def batch_writer(path: str, stream: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that adds a batch to a table once, however often it is replayed.

    A batch owns a folder, which is written anew until the batch is listed; from then on the batch is passed over. `stream`
    names the checkpoint: batch numbers begin at 0 for each one, so a new checkpoint needs a new name.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = written_batches(spark, path).where(f"batch = {int(number)}").collect()
        if any(r["stream"] == stream for r in known):
            return
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={int(number)}")
        entry = spark.createDataFrame([(stream, int(number))], BATCHES_SCHEMA)
        entry.coalesce(1).write.mode("append").json(f"{path}/{BATCHES}")
    return write


def add_available(stream: DataFrame, path: str, checkpoint: str, name: str) -> None:
    """Process everything that has arrived into a table that several streams may share; see `batch_writer`."""
    (stream.writeStream.foreachBatch(batch_writer(path, name)).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of the batches that count, with `stream` and `batch`; what a stopped writer left behind isn't among them."""
    table = spark.read.schema(schema).parquet(path).withColumn("batch", F.col("batch").cast("long"))
    return table.join(written_batches(spark, path), ["stream", "batch"], "left_semi")


def triggers(spark: SparkSession, folder: str) -> DataFrame:
    """Alert payload files, one JSON row each, to trigger rows."""
    log = spark.readStream.schema("ts timestamp, payload string").json(folder)
    return trigger_rows(log)
