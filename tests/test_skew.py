"""Hot keys: a third of all rows on one key must be split or pre-aggregated, never dropped."""

import glob

from pyspark.sql import functions as F

from conftest import SF01
from emberwall.fixtures import log_lines
from emberwall.operators.dedup import dedup_latest
from emberwall.session import local_fs_path, shared_dir
from emberwall.sinks.files import landing_write
from emberwall.sources.jsonl import ingest_project, scan_landing


def _hot_hour_lines(spark):
    """Every second line moved into one hour (about half of all lines)."""
    ln = log_lines(spark, SF01)
    hot = F.regexp_replace("value", r'"timestamp":"[^"]*"', '"timestamp":"2024-01-07T05:30:00Z"')
    return ln.select(F.when(F.crc32("value") % 2 == 0, hot).otherwise(F.col("value")).alias("value"))


def test_hot_hour_is_split_over_writers(spark):
    lines = _hot_hour_lines(spark)
    base = shared_dir(spark, "t-skew")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        landing_write(lines, base)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    landed = scan_landing(spark, base)
    assert landed.count() == lines.count()                       # nothing dropped
    hot = landed.where("dt = '2024-01-07' AND hour = '05'").count()
    assert hot * 3 > lines.count()                               # the hour really is hot
    parts = glob.glob(f"{local_fs_path(base)}/dt=2024-01-07/hour=05/part-*")
    assert len(parts) > 1                                        # written by several tasks


def test_hot_dedup_key_collapses_exactly(spark):
    ln = log_lines(spark, SF01)
    rows = ingest_project(ln)
    one = rows.limit(1).collect()[0]
    copies = spark.range(rows.count()).select(
        F.lit(one["id"]).alias("id"), F.lit(one["timestamp"]).alias("timestamp"),
        (F.lit(one["ingest_ts"]) + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 7)")).alias("ingest_ts"),
        F.lit(one["raw"]).alias("raw"))
    both = rows.unionByName(copies)
    out = dedup_latest(both)
    assert out.count() == dedup_latest(rows).count()
    got = out.where(F.col("id") == one["id"]).where(F.col("timestamp") == F.lit(one["timestamp"])).first()
    assert got["ingest_ts"] == copies.agg(F.max("ingest_ts")).first()[0]
