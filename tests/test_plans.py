"""Physical-plan properties the scale design relies on (read from ``explain()``)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001

QUERIES = entry.queries()


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", ["debuts", "retirements_announced", "transfers_consecutive",
                                  "transfers_with_midseason", "gap_pairs", "gaps_unexplained",
                                  "breaks", "breaks_midseason", "graph_edges", "not_in_announced"])
def test_no_nested_loop_or_cartesian(spark, name):
    text = plan_text(QUERIES[name](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_tookpart_reaches_the_scan(spark):
    text = plan_text(QUERIES["spans"](spark, SF001))
    assert "Not(EqualTo(l_returnflag,R))" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string>" in text


@pytest.mark.parametrize("name", ["transfers_consecutive", "transfers_with_midseason"])
def test_transfers_are_equi_joins_on_driver_and_year(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(QUERIES[name](spark, SF001), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert joins and all("driverId" in j and "_k" in j for j in joins)


def test_breaks_window_is_per_driver_over_distinct_years(spark):
    text = plan_text(QUERIES["breaks"](spark, SF001), "simple")
    windows = [line for line in text.splitlines() if "+- Window [" in line]
    assert len(windows) == 1
    # Partition spec is the driver alone; the rows are distinct (driver, year) pairs.
    assert re.search(r"\], \[driverId#\d+\], \[_y#\d+ ASC", windows[0])


@pytest.mark.parametrize("name", ["last_seen_before_max", "retirements", "retirements_announced", "career_tables"])
def test_one_fact_scan_per_query(spark, monkeypatch, name):
    """Scans of lineitem in the written tables and in the result together."""
    from stintwise.operators import careers
    written = []

    def recording(df, label):
        written.append(plan_text(df, "simple"))
        return materialize(df, label)

    materialize = careers.materialize
    monkeypatch.setattr(careers, "materialize", recording)
    result = QUERIES[name](spark, SF001)
    texts = written + ([plan_text(result, "simple")] if name != "career_tables" else [])
    assert sum("FileScan" in line and "l_orderkey" in line for t in texts for line in t.splitlines()) == 1


def test_driver_filter_reaches_the_orders_scan(spark):
    from stintwise.sources.bindings import appearances
    text = plan_text(appearances(spark, SF001, driver_id="1"))
    assert "EqualTo(o_custkey,1)" in text
    assert appearances(spark, SF001, driver_id="01").count() == 0
    assert appearances(spark, SF001, driver_id="x").count() == 0
