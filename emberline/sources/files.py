"""CSV scans over folders whose files may differ in header layout."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions import clean
from emberline.operators.cleaning import require_columns
from emberline.session import new_folder

LOG = logging.getLogger(__name__)


def n_fields(line: Column) -> Column:
    """How many fields a CSV line has; commas between quotes don't part any."""
    plain = F.when(line.contains('"'), F.regexp_replace(line, r'"(?:[^"]|"")*"', "")).otherwise(line)
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per CSV file that isn't empty: `file_path`, `header` (its first line that is not blank, or ""), `n_lines`
    (not blank ones, the header included) and `n_fields` (of its widest line, 0 without lines).

    Lines are counted by fixed-size aggregates in each task. The text is then read again, its first blocks only kept, for the
    headers; their lines stay where they are if Spark finds the counts, a row per file, small enough to broadcast.
    """
    def reader():
        return spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    path = F.col("_metadata.file_path").alias("file_path")
    # Only the listing: the content column is pruned and no file is opened.
    files = reader().format("binaryFile").load(folder).filter(F.col("_metadata.file_size") > 0).select(path)
    lines = (reader().text(folder).filter(F.col("value").rlike(r"\S"))
             .select(path, "value", (F.col("_metadata.file_block_start") == 0).alias("_top"), F.monotonically_increasing_id().alias("_at")))
    counted = lines.groupBy(F.col("file_path").alias("_path")).agg(
        F.min(F.when(F.col("_top"), F.col("_at"))).alias("_first"), F.count(F.lit(1)).alias("n_lines"), F.max(n_fields(F.col("value"))).alias("n_fields"))
    first = lines.filter("_top").select(F.col("file_path").alias("_of"), "_at", F.col("value").alias("header"))
    known = counted.join(first, (F.col("_path") == F.col("_of")) & (F.col("_first") == F.col("_at")), "left")
    return files.join(known, F.col("file_path") == F.col("_path"), "left").select(
        "file_path", F.coalesce("header", F.lit("")).alias("header"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("n_fields", F.lit(0)).alias("n_fields"))


def csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """First line of every file that is not blank: `file_path`, `header`. A file without one has the header ""."""
    return csv_files(spark, folder).select("file_path", "header")


def quarantine(files: DataFrame, required: list[str]) -> DataFrame:
    """The files of `csv_files` that a scan leaves out, with the reason and their counts.

    A file goes if its header lacks a required column, or if any line has more fields than the header: then it can't be
    told which value belongs where. Lines with fewer fields stay, the rest of their columns null.
    """
    names = F.transform(F.split(F.ltrim(F.col("header"), F.lit("\ufeff")), ","), lambda c: F.trim(F.trim(c), F.lit('"')))
    absent = F.sort_array(F.array_except(F.array(*[F.lit(c) for c in required]).cast("array<string>"), names))
    return (files.withColumns({"absent": absent, "n_header": n_fields(F.col("header"))})
            .withColumn("reason", F.when(F.size("absent") > 0, F.concat(F.lit("no columns "), F.array_join("absent", ", ")))
                        .when(F.col("n_fields") > F.col("n_header"), "a line with too many fields"))
            .filter(F.col("reason").isNotNull()).select("file_path", "reason", "n_lines", "n_fields", "n_header"))


def header_contract(headers: DataFrame) -> DataFrame:
    """Which columns a header lacks; `accepted` when no critical one is missing."""
    names = F.transform(F.split("header", ","), lambda c: F.trim(c))

    def missing(wanted: list[str]) -> Column:
        return F.sort_array(F.array_except(F.array(*[F.lit(w) for w in wanted]), names))
    return (headers.withColumns({"missing_critical": missing(S.HEADER_CRITICAL),
                                 "missing_extra": missing(S.NRT_COLUMNS)})
            .withColumn("accepted", F.size("missing_critical") == 0))


def _layouts(files: DataFrame) -> list[tuple[str, str]]:
    """(path, header) pairs: one per directory whose files agree, one per file elsewhere.

    So the driver holds a row per directory, not per file, unless a directory is mixed.
    """
    headers = files.withColumn("dir", F.regexp_replace("file_path", "/[^/]*$", ""))
    dirs = headers.groupBy("dir").agg(F.min("header").alias("low"), F.max("header").alias("high")).collect()
    pairs = [(r["dir"], r["low"]) for r in dirs if r["low"] == r["high"]]
    mixed = [r["dir"] for r in dirs if r["low"] != r["high"]]
    if mixed:
        pairs += [(r["file_path"], r["header"])
                  for r in headers.filter(F.col("dir").isin(mixed)).select("file_path", "header").collect()]
    return pairs


def _distinct(names: Iterable[str]) -> tuple[str, ...]:
    """Column names with a number after each that was there before."""
    out: list[str] = []
    for name in names:
        n, own = 1, name
        while own.lower() in map(str.lower, out):
            own, n = f"{name}.{n}", n + 1
        out.append(own)
    return tuple(out)


def _read(spark: SparkSession, columns: list[str], paths: list[str], root: str = "", renamed: bool = False,
          without: DataFrame | None = None) -> DataFrame:
    schema = S.text_schema(columns)
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv").option("enforceSchema", renamed).option("escape", '"')
    if root:
        schema, reader = schema.add(S.ENTITY, "string"), reader.option("basePath", root)
    rows = reader.schema(schema).csv(paths).select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("_file_path"))
    if without is not None:
        rows = rows.join(without.select(F.col("file_path").alias("_file_path")), "_file_path", "left_anti")
    return rows.drop("_file_path")


def scan_csv(spark: SparkSession, folder: str, required: list[str], strict: bool = False,
             columns: list[str] | None = None) -> DataFrame | None:
    """Union by name over all files, everything as text, plus `file_name`.

    Spark matches an explicit schema to columns by position, so files are read per distinct
    header. That takes a pass over the text to find the headers; `columns`, for a folder of one
    known layout, saves it, and a file with another header then fails the job. Files in `quarantine`
    are skipped with a warning, or an error if `strict`. No usable file gives None.
    """
    if columns is not None:
        return _read(spark, columns, [folder])
    # One row per file, stored: layouts, verdicts and the rows' own filter come from one pass over the text.
    stored = new_folder(spark, "csv-files")
    csv_files(spark, folder).write.parquet(stored)
    files = spark.read.parquet(stored)
    wide = quarantine(files, []).select("file_path")
    some = quarantine(files, required).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("file_path", "reason")).alias("one"),
                                           F.count_if(F.col("n_fields") > F.col("n_header")).alias("wide")).first()
    if some["n"] and strict:
        lacks = some["one"]["reason"].startswith("no columns ")
        raise ValueError(f"{some['one']['file_path']} {'is missing required columns' if lacks else 'has'}: "
                         f"{some['one']['reason'].removeprefix('no columns ')}")
    if some["n"]:
        LOG.warning("skipped %d files of %s, among them %s: %s", some["n"], folder, some["one"]["file_path"], some["one"]["reason"])
    layouts: dict[tuple[str, tuple[str, ...], bool], list[str]] = defaultdict(list)
    for path, header in _layouts(files):
        stated = tuple(c.strip().strip('"') for c in header.lstrip("\ufeff").split(","))
        names = _distinct(stated)
        if set(required) - set(names):
            continue
        path = unquote(path)    # paths in metadata are encoded, the reader's are not
        root, partitioned, _ = path.partition(f"/{S.ENTITY}=")
        layouts[(root if partitioned else "", names, names != stated)].append(path)
    out = None
    for (root, names, renamed), paths in sorted(layouts.items()):
        part = _read(spark, list(names), sorted(paths), root, renamed, wide if some["wide"] else None)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def scan_detections(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame | None:
    """Detections of all layouts. The area is the `province_id=` folder, else the name's prefix."""
    df = scan_csv(spark, folder, S.HEADER_CRITICAL, columns=columns)
    if df is None or S.ENTITY in df.columns:
        return df
    return df.withColumn(S.ENTITY, clean.file_prefix(F.col("file_name")))


def scan_weather(spark: SparkSession, folder: str) -> DataFrame | None:
    return scan_csv(spark, folder, S.WEATHER_REQUIRED)


def scan_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Archive files with numeric coordinates; a bad layout, or no file, is an error."""
    df = scan_csv(spark, folder, S.DETECTION_REQUIRED, strict=True)
    if df is None:
        raise FileNotFoundError(f"no CSV files in {folder}")
    require_columns(df, S.DETECTION_REQUIRED, "archive")
    numbers = df.withColumns({c: clean.clean_double(F.col(c)) for c in ("latitude", "longitude")})
    return numbers.dropna(subset=["latitude", "longitude"])
