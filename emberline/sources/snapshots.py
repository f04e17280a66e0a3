"""Snapshot tables: append-only, partitioned by kind and time, and listed in a manifest.

A snapshot counts once the manifest has its row, so one whose write was stopped half-way is never read. The manifest's
folder begins with an underscore, which readers of the table's own files pass over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCTION = "prod"
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "kind string, snapshot_ts string, n_files long, n_rows long, schema string"


def snapshot_folder(path: str, kind: str, stamp: str) -> str:
    return f"{path}/kind={kind}/snapshot_ts={stamp}"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per complete snapshot."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every complete snapshot, with columns of older layouts filled with null."""
    listed = manifest(spark, path).select("kind", "snapshot_ts").distinct()
    return spark.read.option("mergeSchema", True).parquet(path).join(listed, ["kind", "snapshot_ts"], "left_semi")


def latest_snapshot(spark: SparkSession, path: str, kind: str = PRODUCTION) -> DataFrame:
    """The newest complete snapshot of one kind; no other snapshot's files are opened."""
    stamp = manifest(spark, path).where(F.col("kind") == kind).agg(F.max("snapshot_ts")).first()[0]
    if stamp is None:
        raise ValueError(f"no complete snapshot of kind {kind!r} in {path}")
    return spark.read.parquet(snapshot_folder(path, kind, stamp))
