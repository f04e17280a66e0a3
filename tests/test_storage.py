from __future__ import annotations

import datetime as dt
import json

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.plans import retrain as T
from emberline.session import new_folder, shared_folder
from emberline.sinks import tables as K
from emberline.sources import files as R
from emberline.sources import payloads as Y
from emberline.sources import snapshots as Z

NRT = ",".join(S.NRT_COLUMNS)
ARCHIVE = ",".join(S.ARCHIVE_COLUMNS)


def line(lat, extra=0):
    return ",".join([str(lat), "101", "300", "1", "1", "2024-01-01", "518", "N", "VIIRS", "h", "2", "290", "4.5", "D"] + ["0"] * extra)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "riau_20240101_000000_UTC.csv").write_text(f"{NRT}\n{line(1)}\n{line(2)}\n")
    (tmp_path / "kalbar_2024-01-01_2024-01-02_archive.csv").write_text(f"{ARCHIVE}\n{line(3, 1)}\n")
    (tmp_path / "jambi_x_UTC.csv").write_text("frp,latitude,acq_time,acq_date,longitude\n9.5,4,100,2024-01-01,102\n")
    (tmp_path / "empty_x_UTC.csv").write_text("")
    (tmp_path / "sumsel_x_UTC.csv").write_text("Invalid API call\n")
    (tmp_path / "bare_x_UTC.csv").write_text(f"{line(5)}\n{line(6)}\n")
    (tmp_path / "notes.txt").write_text("latitude\n1\n")
    return str(tmp_path)


def test_layouts_are_matched_by_name(spark, folder):
    got = {float(r["latitude"]): r for r in R.scan_detections(spark, folder).collect()}
    assert {k: r[S.ENTITY] for k, r in got.items()} == {1.0: "riau", 2.0: "riau", 3.0: "kalbar", 4.0: "jambi"}
    assert got[4.0]["frp"] == "9.5" and got[4.0]["confidence"] is None
    assert got[3.0]["type"] == "0" and got[1.0]["type"] is None


def test_header_contract(spark, folder):
    rows = R.header_contract(R.csv_headers(spark, folder)).withColumn("f", F.regexp_extract("file_path", "([a-z]+)_[^/]*$", 1))
    got = {r["f"]: (r["accepted"], r["missing_critical"]) for r in rows.collect()}
    assert got["sumsel"] == (False, sorted(S.HEADER_CRITICAL)) and got["riau"] == (True, []) and got["jambi"][0]
    assert "empty" not in got and got["bare"] == got["sumsel"]


def test_archive_needs_its_columns_and_a_file(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="missing required columns"):
        R.scan_archive(spark, folder)
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        R.scan_archive(spark, str(tmp_path / "none"))


def test_known_layout_skips_discovery_and_checks_headers(spark, tmp_path):
    (tmp_path / "riau_a_UTC.csv").write_text(f"{NRT}\n{line(1)}\n")
    assert R.scan_detections(spark, str(tmp_path), S.NRT_COLUMNS).count() == 1
    (tmp_path / "riau_b_UTC.csv").write_text(f"{ARCHIVE}\n{line(1, 1)}\n")
    with pytest.raises(Exception, match="(?i)header"):
        R.scan_detections(spark, str(tmp_path), S.NRT_COLUMNS).collect()


def test_weather_payload(spark):
    good = {"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [30.0, None]}}
    df = spark.createDataFrame([("a", json.dumps(good))], "province_id string, payload string")
    rows = Y.weather_rows(df).collect()
    assert [(r["date"], r["temperature_2m_max"], r["precipitation_sum"]) for r in rows] == [
        (dt.date(2024, 1, 1), 30.0, None), (dt.date(2024, 1, 2), None, None)]
    assert "fetched_at_utc" not in rows[0].asDict()
    bad = spark.createDataFrame([("b", json.dumps({"daily": {}}))], "province_id string, payload string")
    with pytest.raises(Exception, match="without daily.time for b"):
        Y.weather_rows(bad).collect()


def test_snapshots_append_and_do_not_multiply(spark):
    path = new_folder(spark, "snap")
    df = spark.range(3).withColumn("x", F.lit(1))
    K.write_snapshot(df, path, now=dt.datetime(2024, 1, 1))
    K.write_snapshot(df, path, now=dt.datetime(2024, 1, 2))
    K.write_snapshot(df.union(df), path, kind="wet", now=dt.datetime(2024, 1, 3))
    assert K.write_snapshot(df, path, dry_run=True) is None
    table = Z.read_snapshots(spark, path)
    assert table.count() == 12
    assert Z.latest_snapshot(spark, path).count() == 3 and Z.latest_snapshot(spark, path, "wet").count() == 6
    moment = dt.datetime(2024, 1, 4)
    K.write_snapshot(df, path, now=moment)
    K.write_snapshot(df, path, now=moment.replace(microsecond=7))
    assert Z.latest_snapshot(spark, path).count() == 3
    # A broken older snapshot isn't opened.
    folder = path.removeprefix("file:")
    broken = next(p for p in Path(folder).rglob("snapshot_ts=20240101*/*.parquet"))
    broken.write_bytes(b"not parquet")
    assert Z.latest_snapshot(spark, path).count() == 3
    with pytest.raises(ValueError, match="empty"):
        K.write_snapshot(df.filter("id < 0"), path)


def test_a_snapshot_without_its_manifest_row_is_not_read(spark):
    path = new_folder(spark, "half")
    df = spark.range(5)
    with pytest.raises(AnalysisException):
        Z.latest_snapshot(spark, path)
    stamp = K.write_snapshot(df, path, now=dt.datetime(2024, 1, 1))
    spark.range(50).write.parquet(Z.snapshot_folder(path, Z.PRODUCTION, "20250101_000000_000000"))  # stopped before its manifest row
    assert Z.latest_snapshot(spark, path).count() == 5 and Z.read_snapshots(spark, path).count() == 5
    entry = Z.manifest(spark, path).first()
    assert (entry["kind"], entry["snapshot_ts"], entry["n_rows"]) == (Z.PRODUCTION, stamp, 5) and entry["n_files"] >= 1 and "bigint" not in entry["schema"]
    with pytest.raises(ValueError, match="empty"):
        K.write_snapshot(df.where("id < 0"), path, now=dt.datetime(2026, 1, 1))
    assert Z.latest_snapshot(spark, path).count() == 5 and Z.manifest(spark, path).count() == 1
    with pytest.raises(ValueError, match="no complete snapshot"):
        Z.latest_snapshot(spark, path, "other")


def test_predictions_keep_nulls(spark):
    from emberline.operators.scoring import prediction_rows
    scored = spark.createDataFrame([("a", 3, dt.date(2024, 1, 1), 12.8), ("b", 1, dt.date(2024, 1, 1), None)],
                                   "province_id string, hotspot_count long, date date, prediction double")
    path = new_folder(spark, "pred")
    K.write_predictions(prediction_rows(scored), path)
    got = {r["province_id"]: (r["risk_level"], r["risk_label"]) for r in spark.read.json(path).collect()}
    assert got == {"a": (2, "Bahaya"), "b": (None, None)}


def test_round_report_is_nested(spark):
    decided = spark.createDataFrame([("m", "r", 1.0, "p", 1, None, "promote", "first")],
                                    "model string, new_run_id string, new_metric double, prod_run_id string, prod_version int, "
                                    "prod_metric double, decision string, detail string")
    path = new_folder(spark, "report")
    for _ in range(2):
        K.append_report(T.round_report(decided, F.lit("t"), F.lit("manual")), path)
    rows = spark.read.json(path).collect()
    assert len(rows) == 2 and [s["name"] for s in rows[0]["stages"]] == ["evaluate_new", "get_production", "decide", rows[0]["decision"]]


def test_a_round_that_is_retried_keeps_one_report(spark):
    path = new_folder(spark, "reports")
    for detail in ("first", "again"):
        K.append_report(spark.createDataFrame([("m", detail)], "model string, detail string"), path, "r1")
    K.append_report(spark.createDataFrame([("m", "other")], "model string, detail string"), path, "r2")
    assert sorted((r["round_id"], r["detail"]) for r in spark.read.json(path).collect()) == [("r1", "again"), ("r2", "other")]


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == shared_folder(spark)
    if root:
        assert shared_folder(spark) == root.rstrip("/")


def test_odd_headers(spark, tmp_path):
    """A blank first line, a header that begins with a digit or a sign, a repeated column."""
    (tmp_path / "a_20240101_UTC.csv").write_text("\n  \nlatitude,longitude,acq_date,acq_time,frp\n1.5,2,2024-01-01,5,3\n")
    (tmp_path / "b_20240101_UTC.csv").write_text("-x,latitude,longitude,acq_date,acq_time,frp\n0,4,2,2024-01-01,5,3\n")
    (tmp_path / "c_20240101_UTC.csv").write_text("latitude,longitude,acq_date,acq_time,frp,note,note\n7,2,2024-01-01,5,3,p,q\n")
    got = R.scan_detections(spark, str(tmp_path))
    assert sorted((r[S.ENTITY], float(r["latitude"])) for r in got.collect()) == [("a", 1.5), ("b", 4.0), ("c", 7.0)]
    assert got.filter("latitude = '7'").select("note", "`note.1`").first() == ("p", "q")


def test_files_with_wide_lines_are_left_out_and_listed(spark, tmp_path):
    head = "latitude,longitude,acq_date,acq_time,frp,note"
    good = "1,2,2024-01-01,5,3"
    (tmp_path / "a_1_UTC.csv").write_text(f'{head}\n{good},"x, y"\n{good},"say ""a, b"""\n')     # commas in quotes part nothing
    (tmp_path / "b_1_UTC.csv").write_text(f"{head}\n{good}\n{good},p\n")                          # a short line stays
    (tmp_path / "c_1_UTC.csv").write_text(f"{head}\n{good},p\n\n{good},p,q\n{good},p\n")
    (tmp_path / "d 1_UTC.csv").write_text(f"{head}\n{good},p,q\n")
    (tmp_path / "e_1_UTC.csv").write_text("latitude,longitude\n1,2,3\n")
    (tmp_path / "f_1_UTC.csv").write_text("")
    (tmp_path / "g_1_UTC.csv").write_text("\n \n")
    found = R.quarantine(R.csv_files(spark, str(tmp_path)), S.HEADER_CRITICAL)
    got = {r["file_path"].rsplit("/", 1)[1][0]: (r["reason"].split(" ")[0], r["n_lines"], r["n_fields"], r["n_header"]) for r in found.collect()}
    assert got == {"c": ("a", 4, 7, 6), "d": ("a", 2, 7, 6), "e": ("no", 2, 3, 2), "g": ("no", 0, 0, 1)}
    rows = R.scan_detections(spark, str(tmp_path))
    assert sorted((r[S.ENTITY], r["note"] or "") for r in rows.collect()) == [("a", 'say "a, b"'), ("a", "x, y"), ("b", ""), ("b", "p")]
    with pytest.raises(ValueError, match="too many fields"):
        (tmp_path / "strict").mkdir()
        (tmp_path / "strict" / "x.csv").write_text(f"{head}\n{good},p,q\n")
        R.scan_csv(spark, str(tmp_path / "strict"), S.HEADER_CRITICAL, strict=True)


def test_split_files_over_boxes_with_a_common_edge(spark, tmp_path):
    """No box covers a cell at the line 4.9, where all of them end; cells there are not cut down to the last level."""
    from emberline.operators.spatial import assign_many
    boxes = [(i, f"b{i}", f"b{i}", 3.3, 100 + i % 40 / 10, 4.9, 103 + i % 40 / 10) for i in range(300)]
    areas = spark.createDataFrame(boxes, S.AREA_SCHEMA)
    rows = [(i, 4.8 + i % 2 / 10 + i % 3 / 100, 99.55 + i / 10) for i in range(90)]
    df = assign_many(spark.createDataFrame(rows, "event_id long, latitude double, longitude double"), areas)
    K.write_split(df.withColumn("acq_date", F.lit(dt.date(2024, 1, 1))), areas, str(tmp_path / "split"))
    back = spark.read.option("header", True).csv(str(tmp_path / "split"))
    want = {i: next((b[1] for b in boxes if b[3] <= lat <= b[5] and b[4] <= lon <= b[6]), None) for i, lat, lon in rows}
    assert {int(r["event_id"]): r[S.ENTITY] for r in back.collect()} == {i: b for i, b in want.items() if b}
