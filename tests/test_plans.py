"""Plan-shape guards: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from emberwall.fixtures import fw_raw, log_lines
from emberwall.plans.catalog import QUERIES
from emberwall.sources.jsonl import ingest_project, ingest_rejects, with_partition_key

FORBIDDEN = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin", "BroadcastExchange", "BroadcastHashJoin")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_udf_no_cartesian_no_broadcast(spark, key):
    plan = plan_of(E.queries()[key](spark, SF001))
    for word in FORBIDDEN:
        assert word not in plan, f"{key}: {word} in plan"


def test_classification_is_narrow(spark):
    plan = plan_of(E.queries()["analyze_batch"](spark, SF001))
    # the only exchange is the fixture's, which deals its records by id
    assert plan.count("Exchange") == plan_of(fw_raw(spark, SF001)).count("Exchange")


def test_a_line_is_parsed_once(spark):
    lines = log_lines(spark, SF001)
    for frame in (ingest_project(lines), ingest_rejects(lines), with_partition_key(lines)):
        assert plan_of(frame).count("from_json") == 1


def test_paging_is_bounded_top_k(spark):
    plan = plan_of(E.queries()["page_logs"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def test_filters_reach_the_parquet_scan(spark):
    import contextlib
    import io

    df = E.queries()["filter_equals"](spark, SF001)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if "PushedFilters" in ln]
    assert any("EqualTo(severity,High)" in ln and "EqualTo(action,DROP)" in ln for ln in pushed), pushed


def test_dedup_aggregates_partially(spark):
    plan = plan_of(E.queries()["dedup_latest"](spark, SF001))
    assert "partial_max" in plan
    assert "Window" not in plan
