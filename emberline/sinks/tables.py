"""Writers."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberline import schemas as S
from emberline.operators.spatial import split_manifest
from emberline.sources.snapshots import MANIFEST, MANIFEST_SCHEMA, PRODUCTION


def write_snapshot(df: DataFrame, path: str, kind: str = PRODUCTION, now: datetime | None = None,
                   dry_run: bool = False) -> str | None:
    """Append one snapshot, stamped to the microsecond; older ones stay. An empty result is an error.

    The snapshot counts once its row in the manifest is there, which is written last: kind, stamp, files, rows and
    schema. Files and rows are read off the new folder, not by a second run of the plan.
    """
    if dry_run:
        return None
    moment = now or datetime.now(timezone.utc)
    stamp = f"{moment:%Y%m%d_%H%M%S_%f}"
    stamped = df.withColumns({"kind": F.lit(kind), "snapshot_ts": F.lit(stamp)})
    stamped.write.mode("append").partitionBy("kind", "snapshot_ts").option("compression", "snappy").parquet(path)
    spark = df.sparkSession
    back = spark.read.schema(stamped.schema).parquet(path).where((F.col("kind") == kind) & (F.col("snapshot_ts") == stamp))
    found = back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col("_metadata.file_path")).alias("n_files")).first()
    if not found["n_rows"]:
        raise ValueError("the dataset to write is empty")
    entry = spark.createDataFrame([(kind, stamp, found["n_files"], found["n_rows"], df.schema.json())], MANIFEST_SCHEMA)
    entry.coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")
    return stamp


def write_split(df: DataFrame, areas: DataFrame, path: str, entity: str = S.ENTITY) -> DataFrame:
    """One CSV folder per area, and the manifest with rows and dates per area.

    Rows are rebalanced by area before they are written: Spark joins small areas in one task and splits
    large ones, so files are few and even. The manifest is read off the folder, not from a second run of the plan.
    """
    (df.dropna(subset=[entity]).hint("rebalance", F.col(entity)).write.mode("overwrite").partitionBy(entity).option("header", True).csv(path))
    values = StructType([f for f in df.schema if f.name != entity] + [df.schema[entity]])
    return split_manifest(df.sparkSession.read.schema(values).option("header", True).csv(path), areas, entity)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """JSON rows, nulls written out."""
    predictions.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_report(report: DataFrame, path: str, round_id: str | None = None) -> None:
    """Add a report to those in `path`. With a round's id it has its own folder, so a round that is retried
    replaces its report in place of adding a second one."""
    target, mode = (path, "append") if round_id is None else (f"{path}/round_id={round_id}", "overwrite")
    report.write.mode(mode).option("ignoreNullFields", False).json(target)
