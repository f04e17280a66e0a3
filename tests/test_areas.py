from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import spatial as X
from emberline.sources import areas as A


def points(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = [(i, round(r.uniform(-6, 6), 1), round(r.uniform(99, 119), 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, latitude double, longitude double")


def first(boxes, lat, lon):
    return next((b[0] for b in boxes if b[1] <= lat <= b[3] and b[2] <= lon <= b[4]), None)


def test_case_and_grid_agree_with_a_loop(spark):
    rows, df = points(spark)
    boxes = X.configured_boxes()
    want = {i: first(boxes, lat, lon) for i, lat, lon in rows}
    few = {r["id"]: r[S.ENTITY] for r in X.assign_few(df, boxes).collect()}
    assert few == want and None in want.values()
    for degrees in (0.7, 1.0, 5.0):
        many = {r["id"]: r[S.ENTITY] for r in X.assign_many(df, A.default_areas(spark), degrees).collect()}
        assert many == want


def test_many_overlapping_boxes_keep_every_row_once(spark):
    rows, df = points(spark, 2000, 2)
    r = random.Random(5)
    boxes = [(f"b{i}", lat := round(r.uniform(-6, 5), 1), lon := round(r.uniform(99, 117), 1), lat + r.choice([0.5, 3.0]), lon + 2.0)
             for i in range(300)]
    table = spark.createDataFrame([(i, b[0], b[0], *[float(x) for x in b[1:]]) for i, b in enumerate(boxes)], S.AREA_SCHEMA)
    got = {r["id"]: r[S.ENTITY] for r in X.assign_many(df, table).collect()}
    assert got == {i: first(boxes, lat, lon) for i, lat, lon in rows}
    assert {r["id"]: r[S.ENTITY] for r in X.assign_few(df, boxes).collect()} == got


@pytest.mark.parametrize("salts", [1, 3])
def test_many_small_boxes_in_one_degree_and_one_world_wide(spark, salts):
    """Cells are cut until lists are short; every point still meets one of them, on edges, too."""
    r = random.Random(8)
    boxes = [(f"b{i}", lat := r.randint(0, 990) / 1000, lon := 100 + r.randint(0, 990) / 1000, lat + 0.01, lon + 0.01) for i in range(10_000)]
    boxes.append(("world", -90.0, -180.0, 90.0, 180.0))
    table = spark.createDataFrame([(i, b[0], b[0], *map(float, b[1:])) for i, b in enumerate(boxes)], S.AREA_SCHEMA)
    rows = [(i, r.randint(0, 1000) / 1000, 100 + r.randint(0, 1000) / 1000) for i in range(400)] + [(1000, 50.0, 50.0), (1001, -89.5, -179.5), (1002, 91.0, 0.0), (1003, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double")
    got = [(x["id"], x[S.ENTITY]) for x in X.assign_many(df, table, salts=salts).collect()]
    assert sorted(got) == [(i, None if lat is None else first(boxes, lat, lon)) for i, lat, lon in rows]
    coarse, fine = X.area_cells(table, 1.0)
    longest = fine.agg(F.max(F.size("_boxes"))).first()[0]
    assert longest <= X.CELL_BOXES and coarse.where(F.size("_boxes") > X.CELL_BOXES).isEmpty() and coarse.where("_levels is not null").count() >= 1


def test_boxes_that_share_a_point_end_in_the_last_level(spark):
    boxes = [(f"b{i}", 0.5, 100.5, 0.5, 100.5 + i / 1e9) for i in range(200)]
    table = spark.createDataFrame([(i, b[0], b[0], *map(float, b[1:])) for i, b in enumerate(boxes)], S.AREA_SCHEMA)
    df = spark.createDataFrame([(1, 0.5, 100.5), (2, 0.5, 100.5 + 1.5e-7), (3, 0.5, 100.6)], "id int, latitude double, longitude double")
    got = {x["id"]: x[S.ENTITY] for x in X.assign_many(df, table, levels=3).collect()}
    assert got == {1: "b0", 2: first(boxes, 0.5, 100.5 + 1.5e-7), 3: None}


def test_grid_join_makes_no_pairs(spark, plan):
    _, df = points(spark, 10)
    text = plan(X.assign_many(df, A.default_areas(spark)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_edges_are_inside(spark):
    df = spark.createDataFrame([(4.5, 106.5), (4.51, 106.5)], "latitude double, longitude double")
    assert [r[S.ENTITY] for r in X.assign_few(df, X.configured_boxes()).collect()] == ["riau", None]


def test_manifest_lists_empty_areas(spark):
    df = spark.createDataFrame([("riau", dt.date(2024, 1, 2)), ("riau", dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 1))],
                               "province_id string, acq_date date")
    got = {r[S.ENTITY]: (r["n_rows"], r["first_date"]) for r in X.split_manifest(df, A.default_areas(spark)).collect()}
    assert got["riau"] == (2, dt.date(2024, 1, 1)) and got["jambi"] == (0, None) and len(got) == 5


def test_selection(spark):
    areas = A.default_areas(spark)
    assert A.select_areas(areas, ["ALL"]).count() == 5
    assert [r[S.ENTITY] for r in A.select_areas(areas, ["RIAU"]).collect()] == ["riau"]
    with pytest.raises(ValueError, match="atlantis"):
        A.select_areas(areas, ["riau", "Atlantis"])
    with pytest.raises(ValueError, match="RIAU"):
        A.select_areas(areas, ["RIAU"], ignore_case=False)


def test_box_validity_is_strict(spark):
    rows = [(1, "ok", None, -1.0, 100.0, 1.0, 101.0), (2, "flat", None, 1.0, 100.0, 1.0, 101.0),
            (3, "far", None, -91.0, 100.0, 1.0, 101.0), (4, "null", None, None, 100.0, 1.0, 101.0)]
    good, bad = A.split_by_validity(spark.createDataFrame(rows, S.AREA_SCHEMA))
    assert [r[S.ENTITY] for r in good.collect()] == ["ok"] and bad.count() == 3


def test_fetch_plan(spark):
    plan_ = A.fetch_plan(spark, A.default_areas(spark), dt.date(2024, 1, 1), dt.date(2024, 1, 12))
    chunks = sorted({(r["chunk_start"].day, r["chunk_end"].day, r["days"]) for r in plan_.collect()})
    assert chunks == [(1, 5, 5), (6, 10, 5), (11, 12, 2)] and plan_.count() == 15
    assert plan_.filter(F.col(S.ENTITY) == "riau").first()["lat_text"] == "2.2500"
    assert all(r["old_start"] for r in plan_.collect())
    with pytest.raises(ValueError, match="after end"):
        A.check_window(dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    with pytest.raises(ValueError, match="future"):
        A.check_window(dt.date(2024, 1, 2), dt.date(2024, 1, 9), today=dt.date(2024, 1, 5))


def edge_boxes(spark, n=300):
    """Boxes that all end on the line 4.9, which no cell's edge meets, so no box ever covers a cell there."""
    r = random.Random(3)
    boxes = [(f"b{i}", r.choice([3.2, 3.7, 4.1]), lon := 100 + r.randint(0, 40) / 10, 4.9, lon + 3.0) for i in range(n)]
    return boxes, spark.createDataFrame([(i, b[0], b[0], *map(float, b[1:])) for i, b in enumerate(boxes)], S.AREA_SCHEMA)


def test_boxes_with_a_common_edge_are_not_cut_without_end(spark):
    """point_in_box_many: of boxes with the same part of a cell only the first can win in it."""
    boxes, table = edge_boxes(spark)
    r = random.Random(4)
    rows = [(i, r.choice([3.2, 4.1, 4.9, 4.95, r.uniform(3, 5)]), r.choice([100.1, r.uniform(99, 108)])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double")
    got = {x["id"]: x[S.ENTITY] for x in X.assign_many(df, table, levels=7).collect()}
    assert got == {i: first(boxes, lat, lon) for i, lat, lon in rows}
    coarse, fine = X.area_cells(table, 1.0, levels=7)
    listed = sum(x.agg(F.sum(F.greatest(F.size("_boxes"), F.lit(0)))).first()[0] for x in (coarse, fine) if x is not None)
    assert listed < 4 * len(boxes)


def test_cutting_ends_where_it_multiplies_rows(spark):
    """Nested boxes, inner ones first: edges everywhere. Lists stay long, results right, and rows bounded."""
    boxes = [(f"b{i}", 0.4 - w, 100.4 - w, 0.4 + w, 100.4 + w) for i, w in enumerate((k + 1) / 800 for k in range(300))]
    table = spark.createDataFrame([(i, b[0], b[0], *map(float, b[1:])) for i, b in enumerate(boxes)], S.AREA_SCHEMA)
    r = random.Random(6)
    rows = [(i, r.uniform(0, 0.9), r.uniform(100, 100.9)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double")
    got = {x["id"]: x[S.ENTITY] for x in X.assign_many(df, table, most=2).collect()}
    assert got == {i: first(boxes, lat, lon) for i, lat, lon in rows}
    _, fine = X.area_cells(table, 1.0, most=2)
    assert fine.agg(F.sum(F.greatest(F.size("_boxes"), F.lit(0)))).first()[0] < 5 * X.GROWTH * len(boxes)


def test_a_box_without_priority_hides_none_of_the_same_part(spark):
    table = spark.createDataFrame([(None, "x", "x", 0.2, 100.2, 0.4, 100.4), (1, "y", "y", 0.2, 100.2, 0.4, 100.4), (2, "z", "z", 0.0, 100.0, 1.0, 101.0)],
                                  f"priority int, {S.ENTITY} string, name string, lat_min double, lon_min double, lat_max double, lon_max double")
    df = spark.createDataFrame([(1, 0.3, 100.3), (2, 0.5, 100.3)], "id int, latitude double, longitude double")
    assert {x["id"]: x[S.ENTITY] for x in X.assign_many(df, table).collect()} == {1: "y", 2: "z"}


def along_the_edge(spark):
    boxes, table = edge_boxes(spark)
    r = random.Random(7)
    rows = [(i, r.choice([4.9, 4.95, r.uniform(4, 5)]), r.uniform(99, 108), dt.date(2024, 1, 1 + i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double, acq_date date")
    return X.assign_many(df, table), table, [(first(boxes, lat, lon), i, day) for i, lat, lon, day in rows]


def test_split_manifest_over_boxes_with_a_common_edge(spark):
    assigned, table, want = along_the_edge(spark)
    got = {r[S.ENTITY]: (r["n_rows"], r["first_date"], r["last_date"]) for r in X.split_manifest(assigned, table).collect()}
    days = {b: [day for x, _, day in want if x == b] for b in got}
    assert len(got) == 300 and got == {b: (len(d), min(d, default=None), max(d, default=None)) for b, d in days.items()}
