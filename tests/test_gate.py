from __future__ import annotations

import datetime as dt

import pytest

from emberline.operators import gate as G
from emberline.operators import metrics as M

NAN = float("nan")
RUNS = "run_id string, model string, start_time timestamp, rmse double, mae double, f1_macro double, recall_bahaya double"


def runs(spark, *rows):
    return spark.createDataFrame([(f"r{i}", m, dt.datetime(2024, 1, 1 + i), *x) for i, (m, *x) in enumerate(rows)], RUNS)


def test_gate_modes(spark):
    df = runs(spark, ("m", 12.0, 8.0, 0.78, 0.85), ("m", 12.01, 9.0, 0.5, 0.1), ("m", None, NAN, None, None), ("m", 49.0, 29.0, 0.31, 0.0))
    full = {r["run_id"]: r for r in G.evaluate_gate(df).collect()}
    assert full["r0"]["passed"] and not full["r2"]["passed"]
    assert full["r2"]["failed_checks"] == [f"{m} is missing" for m in ("rmse", "mae", "f1_macro", "recall_bahaya")]
    assert all(r["passed"] for r in G.evaluate_gate(df, required=()).collect() if r["run_id"] == "r2")
    assert full["r1"]["failed_checks"] == ["rmse=12.01 > threshold 12.0", "mae=9.00 > threshold 8.0",
                                           "f1_macro=0.500 < threshold 0.78", "recall_bahaya=0.100 < threshold 0.85"]
    lenient = {r["run_id"]: r["passed"] for r in G.evaluate_gate(df, G.CI_THRESHOLDS, required=()).collect()}
    assert all(lenient.values())
    strict = {r["run_id"]: r["failed_checks"] for r in G.evaluate_gate(df, required=("rmse", "mae")).collect()}
    assert strict["r2"] == ["rmse is missing", "mae is missing"] and strict["r0"] == []


def test_best_and_newest(spark):
    df = runs(spark, ("a", 3.0, 0.0, 0.1, 0.0), ("a", None, 0.0, NAN, 0.0), ("b", 2.0, 0.0, 0.5, 0.0))
    assert {r["model"]: r["run_id"] for r in G.newest_run(df).collect()} == {"a": "r1", "b": "r2"}
    assert {r["model"]: r["run_id"] for r in G.best_run(df).collect()} == {"a": "r0", "b": "r2"}
    assert [r["run_id"] for r in G.best_run(df, "f1_macro", False, ()).collect()] == ["r2"]


@pytest.mark.parametrize("new, prod, lower, want", [
    (None, 1.0, True, "abort"), (5.0, None, True, "promote"), (97.0, 100.0, True, "promote"), (98.0, 100.0, True, "keep-staging"),
    (99.0, 100.0, True, "keep-staging"), (103.0, 100.0, False, "promote"), (102.0, 100.0, False, "keep-staging")])
def test_decision(spark, new, prod, lower, want):
    df = spark.createDataFrame([("m", "r", new, "p", 1, prod)],
                               "model string, new_run_id string, new_metric double, prod_run_id string, prod_version int, prod_metric double")
    assert G.decide(df, lower_is_better=lower).first()["decision"] == want


def versions(spark):
    return spark.createDataFrame([("m", "9", "Production", "r1"), ("m", "10", "Staging", "r2"), ("n", "1", "Production", "r3")],
                                 "name string, version string, stage string, run_id string")


def test_transition_archives_only_in_live_stages(spark):
    def stages(df):
        return {(r["name"], r["version"]): r["stage"] for r in df.collect()}
    up = stages(G.transition_stage(versions(spark), "m", 10, "Production"))
    assert up == {("m", "9"): "Archived", ("m", "10"): "Production", ("n", "1"): "Production"}
    kept = stages(G.transition_stage(versions(spark), "m", 10, "Production", archive_existing=False))
    assert kept[("m", "9")] == "Production"
    with pytest.raises(ValueError):
        G.transition_stage(versions(spark), "m", 10, "Live")


def test_versions_sort_as_numbers(spark):
    assert [r["version"] for r in G.by_version(versions(spark)).collect()] == ["9", "10", "1"]


def test_decisions_add_versions(spark):
    rows = [("m", "r8", 1.0, "promote"), ("n", "r9", 1.0, "keep-staging"), ("new", "r10", 1.0, "promote"), ("z", "r11", None, "abort")]
    decided = spark.createDataFrame(rows, "model string, new_run_id string, new_metric double, decision string")
    got = {(r["name"], r["version"]): (r["stage"], r["run_id"]) for r in G.apply_decisions(versions(spark), decided).collect()}
    assert got == {("m", "9"): ("Archived", "r1"), ("m", "10"): ("Staging", "r2"), ("m", "11"): ("Production", "r8"),
                   ("n", "1"): ("Production", "r3"), ("n", "2"): ("Staging", "r9"), ("new", "1"): ("Production", "r10")}


def test_metrics_with_a_class_seen_on_one_side_only(spark):
    pairs = [(1, 1), (1, 2), (2, 2), (2, 0), (2, 2)]
    df = spark.createDataFrame(pairs, "y int, p int")
    report = M.class_report(M.confusion(df, "y", "p"))
    got = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in report.collect()}
    assert got[0] == (0.0, 0.0, 0.0, 0)
    assert got[1] == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert got[2] == (pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    total = M.classification_metrics(report).first()
    assert total["f1_macro"] == pytest.approx((0 + 2 / 3 + 2 / 3) / 3) and total["recall_bahaya"] == pytest.approx(2 / 3)


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 2, "risk_level int")
    got = {r["risk_level"]: r["weight"] for r in M.with_class_weights(df, "risk_level").distinct().collect()}
    assert got == {1: pytest.approx(8 / 12), 2: pytest.approx(2.0)}
