"""The registered queries: pairing, plans, and the comparison with DuckDB.

At any scale: `python tools/check.py --sf /root/testdata/sf0.01`.
"""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import SMALL

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from emberline.workload import load  # noqa: E402
from tools.check import compare, connect  # noqa: E402

LIBRARY = load()
NAMES = sorted(LIBRARY.ORACLE)
HAVE_DATA = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(LIBRARY.QUERIES) <= set(entry.queries()) and set(LIBRARY.ORACLE) <= set(LIBRARY.QUERIES)


@HAVE_DATA
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@HAVE_DATA
@pytest.mark.parametrize("name", NAMES)
def test_against_duckdb(spark, name):
    con = connect(SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    columns, types = [d[0] for d in cur.description], [d[1] for d in cur.description]
    want = cur.fetchall()
    assert want
    assert compare(entry.queries()[name](spark, SMALL), columns, types, want) == []


@HAVE_DATA
@pytest.mark.parametrize("name", ["training_table", "weather_join", "point_in_box_many", "drift_alert", "attach_forecast",
                                  "apply_decisions", "rmse_trigger", "compare_with_production"])
def test_no_plan_has_a_pairwise_join(spark, plan, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
