"""Searches and point lookups read few files and row groups, and lose no rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from emberwall.fixtures import fw_raw
from emberwall.operators.classify import analyze_batch
from emberwall.operators.search import search_logs
from emberwall.session import shared_dir
from emberwall.sinks import grams as G
from emberwall.sinks.files import curated_write, lookup
from emberwall.sources.tables import read_curated


@pytest.fixture(scope="module")
def table(spark):
    path = shared_dir(spark, "t-grams")
    odd = F.when(F.col("id") == 4321, F.lit("Zyxwv ünlikely 50%_off")).otherwise(F.col("reason"))
    curated_write(analyze_batch(fw_raw(spark, SF01).withColumn("reason", odd)), path)
    assert G.refresh_grams(spark, path) > 20 and G.refresh_grams(spark, path) == 0
    return path


@pytest.mark.parametrize("text", ["zyxWV", "ÜNLIKELY", "ransom", "10.0.1", "zz", "", "zyx%off", "50%_o", "no such text", "a\\%b"])
def test_a_search_equals_the_scan_of_all(spark, table, text):
    got, want = G.search_table(spark, table, text), search_logs(read_curated(spark, table), text)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rare_texts_open_few_files(spark, table):
    every = len(G.search_files(spark, table, ""))
    assert every > 20
    assert len(G.search_files(spark, table, "zyxwv")) == 1 and G.search_files(spark, table, "qqqqqq") == []
    assert len(G.search_files(spark, table, "zz")) == every


def test_new_files_are_searched_before_they_are_indexed(spark):
    path = shared_dir(spark, "t-grams-2")
    rows = analyze_batch(fw_raw(spark, SF01))
    curated_write(rows.where("id % 2 = 0"), path)
    assert G.search_table(spark, path, "ransom").count() > 0          # no index
    G.refresh_grams(spark, path)
    curated_write(rows.where("id % 2 = 1").withColumn("reason", F.lit("qqqqqq")), path)
    assert G.search_table(spark, path, "qqqqqq").count() == rows.where("id % 2 = 1").count()


def _rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_a_lookup_skips_row_groups_by_bloom_filters(spark, table):
    every = read_curated(spark, table).count()
    some = read_curated(spark, table).where("session_id is not null").orderBy(F.crc32("session_id")).first()
    found = lookup(spark, table, "session_id", some["session_id"])
    assert found.count() == read_curated(spark, table).where(F.col("session_id") == some["session_id"]).count()
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _rows_scanned(lookup(spark, table, "session_id", some["session_id"])) < every / 5
        # within the range of every file, in none of them
        assert _rows_scanned(lookup(spark, table, "src_ip", "10.0.5.5x")) < every / 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    with pytest.raises(ValueError):
        lookup(spark, table, "reason", "x")
