"""Newest-first pages from few day folders; the zone map may be stale or missing."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from emberwall.fixtures import fw_raw
from emberwall.operators.classify import analyze_batch
from emberwall.operators.search import chronological_export, page_logs
from emberwall.session import shared_dir
from emberwall.sinks import zones as Z
from emberwall.sinks.files import curated_write
from emberwall.sources.tables import read_curated


@pytest.fixture(scope="module")
def table(spark):
    path = shared_dir(spark, "t-zones")
    curated_write(analyze_batch(fw_raw(spark, SF01)), path)
    Z.refresh_zones(spark, path)
    return path


def _days(df):
    return {r["day"] for r in df.select("day").distinct().collect()}


@pytest.mark.parametrize("args", [
    {}, {"limit": 5}, {"skip": 400, "limit": 100}, {"severity": "High"}, {"severity": "High", "action": "DROP", "limit": 700},
    {"search": "brute"}, {"search": "10.0.1", "action": "DENY", "skip": 20}, {"search": "nowhere"}, {"protocol": "none"},
    {"limit": 10 ** 6}])
def test_pages_equal_the_scan_of_all(spark, table, args):
    got = Z.newest_page(spark, table, **args)
    want = page_logs(read_curated(spark, table), **args)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_a_page_reads_few_days(spark, table):
    every = _days(read_curated(spark, table))
    assert len(every) >= 20
    plain = Z.newest_page(spark, table, skip=0, limit=100)
    days = Z.newest_days(spark, table, 100)
    assert len(days) <= 2
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    named = set(re.findall(r"\d{4}-\d\d-\d\d|unknown", re.search(r"PartitionFilters: \[.*?\], PushedFilters", plan)[0]))
    assert named == set(days)
    assert len(Z.newest_days(spark, table, 50, severity="High", action="DROP")) < len(every)


def test_stale_and_missing_maps_cost_no_rows(spark, table):
    path = shared_dir(spark, "t-zones-2")
    first = analyze_batch(fw_raw(spark, SF01)).where(F.col("id") % 2 == 0)
    curated_write(first, path)
    assert Z.newest_page(spark, path).count() == 100            # no map
    assert Z.refresh_zones(spark, path) and Z.refresh_zones(spark, path) == []
    curated_write(analyze_batch(fw_raw(spark, SF01)).where((F.col("id") % 2 == 1)), path)   # the map is stale
    want = [tuple(r) for r in page_logs(read_curated(spark, path), 0, 300).drop("created_at").collect()]
    assert [tuple(r) for r in Z.newest_page(spark, path, 0, 300).drop("created_at").collect()] == want
    assert set(Z.refresh_zones(spark, path)) == _days(read_curated(spark, path))


def test_chronological_export_is_in_order_within_and_across_files(spark, table):
    out = shared_dir(spark, "t-export")
    chronological_export(read_curated(spark, table), 6).select("id", "timestamp").write.parquet(out)
    files = sorted(spark.read.parquet(out).inputFiles())
    assert len(files) > 1
    rows = [(r["timestamp"] is None, str(r["timestamp"]), r["id"]) for f in files for r in spark.read.parquet(f).collect()]
    assert rows == sorted(rows) and len(rows) == read_curated(spark, table).count()
