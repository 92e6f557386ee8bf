"""Plan-shape guards for every registered query (scale properties, not values)."""

import re

import pytest

import __spark_entry__ as entry_mod
from tickbar.plans.catalog import QUERIES as CATALOG

SMOKE = "/root/testdata/sf0.001"
NAMES = sorted(CATALOG)  # the pipeline operators have tests of their own


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: _plan(entry_mod.queries()[n](spark, SMOKE)) for n in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_no_python(plans, name):
    p = plans[name]
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "RoundRobinPartitioning" not in p


@pytest.mark.parametrize("name", NAMES)
def test_scans_are_pruned(plans, name):
    # driver tables (events, orders) have 6 columns; every scan of them reads fewer
    # (read-backs of tables a query wrote itself legitimately read all their columns)
    for line in plans[name].splitlines():
        if "FileScan" in line and "/testdata/" in line:
            schema = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
            assert len([c for c in schema.split(",") if c]) <= 5, (name, schema)


def test_one_scan_for_both_models(plans):
    assert plans["model_comparison"].count("FileScan") == 1
    assert plans["rmse_report"].count("FileScan") == 1


@pytest.mark.parametrize("name", ["chart_candles_range", "corr_matrix_range", "bars_last_week_as_of"])
def test_ranges_reach_the_scan(plans, name):
    filters = plans[name].split("PushedFilters: [")[1].split("]")[0]
    assert "o_orderdate" in filters.replace("IsNotNull(o_orderdate)", "")


def test_one_symbol_reaches_the_scan(plans):
    assert "EqualTo(o_orderpriority" in plans["history_one_symbol"]


def test_daily_bars_aggregates_before_its_shuffle(plans):
    p = plans["daily_bars"]
    # the symbol restriction is a semi join above the arg-max, never a join under it
    assert "LeftSemi" in p
    semi_at = p.index("LeftSemi")
    assert "partial_max_by" in p[semi_at:]


def test_one_symbol_reads_one_bucket(plans):
    one, whole = plans["history_one_symbol_bucketed"], plans["history_for_symbol_bucketed"]
    assert re.search(r"SelectedBucketsCount: 1 out of \d+", one)
    for p in (one, whole):  # the buckets are the window's partitions
        assert "Exchange" not in p and "Window" in p
