"""What the plans must and must not hold, since small data hides what large data punishes."""

import pathlib
import re

import pytest

from quayside.plans import QUERIES
from tests.oracle import TESTDATA

SF = f"{TESTDATA}/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parent.parent


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_funnels_rows(spark, name):
    """No cross join, no window or sort that gathers a whole table, no row-wise Python."""
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    for part in re.findall(r"Window \[.*", text):
        assert re.search(r"\], \[[^\]]+\]", part), part
    if "k7_order_limit" not in name:
        assert "rangepartitioning" not in text


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(QUERIES["d1_subset_filter_range"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_" in text and "GreaterThanOrEqual(l_quantity,10.0)" in text
    assert "l_shipdate" not in text
    text = plan(QUERIES["d5_high_water_filter"](spark, SF))
    assert "GreaterThan(o_orderdate" in text and "o_totalprice" not in text


def test_top_rows_per_key_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["k6_qualify"](spark, SF))
    assert "TakeOrderedAndProject" in plan(QUERIES["k7_order_limit"](spark, SF))


def test_dedup_combines_before_the_shuffle(spark):
    text = plan(QUERIES["f5_dedup_latest"](spark, SF))
    assert "partial_max_by" in text and "Window" not in text


def test_sources_hold_no_forbidden_calls():
    for path in (ROOT / "quayside").rglob("*.py"):
        text = path.read_text()
        for call in ("localCheckpoint", "toPandas", "crossJoin", ".rdd.map", "monotonically_increasing_id().over"):
            assert call not in text, f"{path}: {call}"
        for line in text.splitlines():  # what the driver gathers is bounded, and the line says by what
            assert ".collect()" not in line or "# bound: " in line, f"{path}: {line}"
