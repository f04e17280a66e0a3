"""Point-in-box assignment, first matching box wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators.joins import salted_left_join
from emberline.session import new_folder

Box = tuple[str, float, float, float, float]

# An ordered CASE is compiled into one method; past this many boxes the grid join is used.
CASE_LIMIT = 64
# Boxes of a grid cell beyond which it is cut into quarters, and how often at most.
CELL_BOXES, LEVELS = 64, 16
# Rows that the quarters of a coarse cell may hold for each of its own before it is cut no further.
GROWTH = 16


def configured_boxes() -> list[Box]:
    return [(a[0], *a[2:]) for a in S.AREAS]


def first_box(boxes: Sequence[Box], lat: str = "latitude", lon: str = "longitude") -> Column:
    """The id of the first box that holds the point, edges included, else null.

    No join and no shuffle; evaluation stops at the first match.
    """
    out = None
    for name, lat_min, lon_min, lat_max, lon_max in boxes:
        inside = F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max)
        out = F.when(inside, F.lit(name)) if out is None else out.when(inside, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def assign_few(df: DataFrame, boxes: Sequence[Box], out: str = S.ENTITY) -> DataFrame:
    """The first box of a list; a long list is looked up through the grid, with the same result."""
    if len(boxes) <= CASE_LIMIT:
        return df.withColumn(out, first_box(boxes))
    columns = f"priority int, {S.ENTITY} string, lat_min double, lon_min double, lat_max double, lon_max double"
    areas = df.sparkSession.createDataFrame([(i, b[0], *map(float, b[1:])) for i, b in enumerate(boxes)], columns)
    return assign_many(df, areas, out=out)


def _inside(areas: DataFrame, degrees: float) -> DataFrame:
    """The coarse cells of every box: a row per box and cell that it meets, at level 0."""
    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / degrees), F.floor(F.col(high) / degrees))
    return (areas.select("priority", S.ENTITY, "lat_min", "lon_min", "lat_max", "lon_max")
            .withColumn("_cell_lat", F.explode(span("lat_min", "lat_max"))).withColumn("_cell_lon", F.explode(span("lon_min", "lon_max"))))


def _pruned(met: DataFrame, size: float) -> DataFrame:
    """Boxes that may win in their cell, and how many these are.

    Of boxes that hold the same part of a cell only the first is kept, and a box that covers the cell beats all after it.
    Joins are by shuffles: sizes of stored tables, as Spark estimates them, are those of packed files.
    """
    def covers(cell: str, low: str, high: str) -> Column:
        return (F.col(low) <= F.col(cell) * size) & (F.col(high) >= (F.col(cell) + 1) * size)

    def part(cell: str, low: str, high: str) -> list[Column]:
        # A little more than the cell, so that a point rounded into it is judged right, too.
        edge = size / 1024
        return [F.greatest(F.col(low), F.col(cell) * size - edge).alias(f"_{low}"), F.least(F.col(high), (F.col(cell) + 1) * size + edge).alias(f"_{high}")]
    cell, box = ["_cell_lat", "_cell_lon"], ["priority", S.ENTITY, "lat_min", "lat_max", "lon_min", "lon_max"]
    other = [c for c in met.columns if c not in {*cell, *box}]
    # In the order of lists; a box without priority is dropped beside one that covers the cell, so it stands for itself only.
    alike = [*cell, *other, *part("_cell_lat", "lat_min", "lat_max"), *part("_cell_lon", "lon_min", "lon_max"), F.col("priority").isNull().alias("_unranked")]
    first = F.min(F.struct("priority", S.ENTITY, "lat_min", "lon_min", "lat_max", "lon_max")).alias("_first")
    met = met.groupBy(*alike).agg(first).select(*cell, *other, "_first.*")
    full = F.when(covers("_cell_lat", "lat_min", "lat_max") & covers("_cell_lon", "lon_min", "lon_max"), F.col("priority"))
    best = met.groupBy(*cell).agg(F.min(full).alias("_full"))
    live = met.join(best.hint("merge"), cell).where("_full is null or priority <= _full").drop("_full")
    return live.join(live.groupBy(*cell).agg(F.count(F.lit(1)).alias("_live")).hint("merge"), cell)


def _listed(live: DataFrame) -> DataFrame:
    box = F.struct("priority", S.ENTITY, "lat_min", "lon_min", "lat_max", "lon_max")
    return live.groupBy("_cell_lat", "_cell_lon").agg(F.sort_array(F.collect_list(box)).alias("_boxes"))


def area_cells(areas: DataFrame, degrees: float, most: int = CELL_BOXES, levels: int = LEVELS) -> tuple[DataFrame, DataFrame | None]:
    """Coarse cells with the boxes that may win in them, in priority order, or with the levels to which they are split; and the split cells.

    A cell with more than `most` such boxes is cut into quarters, level by level, so lists stay short where many small
    boxes lie together. A list is longer only where more than `most` different parts meet within 1 / 2^`levels` of a cell's
    side, or where the quarters of a coarse cell came to hold more than `GROWTH` times its own boxes: cutting on would
    multiply rows along edges. The number of rounds follows the table of areas, not the points.
    """
    folder = new_folder(areas.sparkSession, "area-cells")

    def settled(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return areas.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    live = settled(_pruned(_inside(areas, degrees), degrees), "level0")
    crowded = live.where(F.col("_live") > most)
    if not levels or crowded.isEmpty():
        return _listed(live).withColumn("_levels", F.lit(None).cast("array<int>")), None
    coarse = _listed(live.where(F.col("_live") <= most)).withColumn("_levels", F.lit(None).cast("array<int>"))
    top = ["_top_lat", "_top_lon"]
    crowded = crowded.withColumns({"_top_lat": F.col("_cell_lat"), "_top_lon": F.col("_cell_lon")})
    own = crowded.groupBy(*top).agg(F.count(F.lit(1)).alias("_own"))
    fine = []
    for level in range(1, levels + 1):
        size, half = degrees / 2 ** level, F.array(F.lit(0), F.lit(1))

        def cut(df: DataFrame) -> DataFrame:
            return (df.withColumn("_i", F.explode(half)).withColumn("_j", F.explode(half))
                    .withColumns({"_cell_lat": F.col("_cell_lat") * 2 + F.col("_i"), "_cell_lon": F.col("_cell_lon") * 2 + F.col("_j")}).drop("_i", "_j"))
        # Every quarter is kept, also one that no box meets, so a point below a split cell always finds just one.
        quarters = cut(crowded.select("_cell_lat", "_cell_lon", *top).distinct())
        met = cut(crowded.drop("_live")).where(
            (F.col("lat_min") < (F.col("_cell_lat") + 1) * size) & (F.col("lat_max") >= F.col("_cell_lat") * size)
            & (F.col("lon_min") < (F.col("_cell_lon") + 1) * size) & (F.col("lon_max") >= F.col("_cell_lon") * size))
        live = settled(_pruned(met, size), f"level{level}")
        grown = live.groupBy(*top).agg(F.count(F.lit(1)).alias("_rows")).join(own.hint("merge"), top).where(F.col("_rows") > GROWTH * F.col("_own"))
        last = level == levels
        crowded = live.where(F.lit(False) if last else F.col("_live") > most).join(grown.select(*top).hint("merge"), top, "left_anti")
        split = crowded.select("_cell_lat", "_cell_lon").distinct()
        leaves = quarters.select(*top, "_cell_lat", "_cell_lon").join(split.hint("merge"), ["_cell_lat", "_cell_lon"], "left_anti")
        listed = leaves.join(_listed(live).hint("merge"), ["_cell_lat", "_cell_lon"], "left").withColumn("_level", F.lit(level))
        fine.append(settled(listed, f"leaves{level}"))
        if crowded.isEmpty():
            break
    every = fine[0]
    for x in fine[1:]:
        every = every.unionByName(x)
    below = every.groupBy(*top).agg(F.sort_array(F.collect_set("_level")).alias("_levels"))
    below = below.select(F.col("_top_lat").alias("_cell_lat"), F.col("_top_lon").alias("_cell_lon"), F.lit(None).cast(coarse.schema["_boxes"].dataType).alias("_boxes"), "_levels")
    return coarse.unionByName(below), every.drop(*top)


def assign_many(df: DataFrame, areas: DataFrame, degrees: float = 1.0, out: str = S.ENTITY,
                salts: int = 1, most: int = CELL_BOXES, levels: int = LEVELS) -> DataFrame:
    """First match out of a whole area table, by equality joins on grid cells.

    Each point meets one row, its cell, so no point-and-box pairs are produced and rows never
    multiply. In a coarse cell that is split, a point probes one cell per level that occurs there, and finds just
    one of them. A crowded cell is a skewed key, which Spark splits; `salts` spreads it by row position besides.
    """
    kept = [c for c in df.columns if c != out]
    coarse, fine = area_cells(areas, degrees, most, levels)
    points = df.select(*kept).withColumns({
        "_cell_lat": F.floor(F.col("latitude") / degrees),
        "_cell_lon": F.floor(F.col("longitude") / degrees)})
    joined = salted_left_join(points, coarse, ["_cell_lat", "_cell_lon"], ["latitude", "longitude"], salts)
    hits = F.filter("_boxes", lambda b: F.col("latitude").between(b["lat_min"], b["lat_max"])
                    & F.col("longitude").between(b["lon_min"], b["lon_max"]))
    found = F.get(hits, F.lit(0))[S.ENTITY].alias(out)
    if fine is None:
        return joined.select(*kept, found)
    whole = joined.where("_levels is null").select(*kept, found)
    scale = F.lit(degrees) / F.pow(F.lit(2.0), F.col("_level"))
    probes = joined.where("_levels is not null").select(*kept, F.explode("_levels").alias("_level")).withColumns({
        "_cell_lat": F.floor(F.col("latitude") / scale), "_cell_lon": F.floor(F.col("longitude") / scale)})
    keys = ["_level", "_cell_lat", "_cell_lon"]
    if salts > 1:
        fine = fine.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        probes, keys = probes.withColumn("_salt", F.pmod(F.hash("latitude", "longitude"), F.lit(salts))), [*keys, "_salt"]
    return whole.unionByName(probes.join(fine, keys).select(*kept, found))


def coverage(df: DataFrame, entity: str = S.ENTITY, date: str = "acq_date") -> DataFrame:
    """Rows inside any box, their share of all rows, and the dates they span."""
    inside = F.col(entity).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(inside).alias("n_inside"),
        F.min(F.when(inside, F.col(date))).alias("first_date"),
        F.max(F.when(inside, F.col(date))).alias("last_date"),
    ).withColumn("share", F.col("n_inside") / F.greatest(F.lit(1), F.col("n_rows")))


def split_manifest(df: DataFrame, areas: DataFrame, entity: str = S.ENTITY, date: str = "acq_date") -> DataFrame:
    """Rows and date span per area; areas without rows are listed with 0."""
    counts = df.dropna(subset=[entity]).groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return (areas.select(entity).join(counts, entity, "left")
            .withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long"))))
