"""Stored rollups kept up to date batch by batch (A9-A11), and unique addresses of any range of hours.

Every batch adds what it comes to, as rows that merge: sums, latest times, and
for each hour a sketch of the addresses seen. The tables are those of
``batches``: a batch that is written again replaces its own rows, and merges
keep them from growing with the number of batches. Nothing is built anew from
the records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from .batches import MERGE_EVERY, merge_batches, read_batches, write_batch

#: Base-2 logarithm of a sketch's buckets: the relative standard error is 1.04 / sqrt(2 ** SKETCH_BITS), 0.8 percent.
SKETCH_BITS = 14
_HOUR_KEYS = ("hour_timestamp", "firewall_id", "protocol", "action")


def _hours(curated: DataFrame) -> DataFrame:
    """Measures of each hour and key, sketches of its addresses in place of their distinct counts."""
    keyed = curated.where(F.col("timestamp").isNotNull() & F.col("firewall_id").isNotNull()
                          & F.col("protocol").isNotNull() & F.col("action").isNotNull())
    return keyed.groupBy(F.date_trunc("hour", "timestamp").alias("hour_timestamp"), *_HOUR_KEYS[1:]).agg(
        F.count("*").alias("events"), F.sum("bytes").alias("bytes"), F.sum("duration_ms").cast("bigint").alias("dur_sum"),
        F.count("duration_ms").alias("dur_n"), F.hll_sketch_agg("src_ip", SKETCH_BITS).alias("src"),
        F.hll_sketch_agg("dst_ip", SKETCH_BITS).alias("dst"))


def _merge_hours(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_HOUR_KEYS).agg(*[F.sum(c).alias(c) for c in ("events", "bytes", "dur_sum", "dur_n")],
                                         *[F.hll_union_agg(c).alias(c) for c in ("src", "dst")])


def _merge_ports(rows: DataFrame) -> DataFrame:
    return rows.groupBy("port", "port_type", "protocol").agg(
        F.sum("total_connections").alias("total_connections"), F.max("last_seen").alias("last_seen"))


def _blocked(curated: DataFrame) -> DataFrame:
    return A.suspicious_ips_build(curated).drop("risk_level")


def _merge_blocked(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ip_address", "ip_type").agg(
        F.sum("blocked_count").alias("blocked_count"), F.max("last_blocked").alias("last_blocked"))


#: Table -> what a batch adds, how rows merge, and their schema.
_TABLES: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame], str]] = {
    "hours": (_hours, _merge_hours, "hour_timestamp timestamp, firewall_id string, protocol string, action string, "
              "events bigint, bytes bigint, dur_sum bigint, dur_n bigint, src binary, dst binary"),
    "ports": (A.top_ports_build, _merge_ports, "port int, port_type string, protocol string, total_connections bigint, "
              "last_seen timestamp"),
    "blocked": (_blocked, _merge_blocked, "ip_address string, ip_type string, blocked_count bigint, last_blocked timestamp"),
}


def update_rollups(curated: DataFrame, base: str, batch_id: int, merge_every: int | None = MERGE_EVERY) -> None:
    """Add one batch of curated records to the stored rollups; the same ``batch_id`` again replaces what it added.

    Each table reads the batch once; give a stored or cached batch.
    """
    for name, (build, merge, schema) in _TABLES.items():
        write_batch(build(curated), f"{base}/{name}", batch_id)
        if merge_every and batch_id % merge_every == merge_every - 1:
            merge_batches(curated.sparkSession, f"{base}/{name}", schema, merge)


def merge_rollups(spark: SparkSession, base: str) -> None:
    """Merge all batches so far, for instance at the end of a run."""
    for name, (_, merge, schema) in _TABLES.items():
        merge_batches(spark, f"{base}/{name}", schema, merge)


def _read(spark: SparkSession, base: str, name: str) -> DataFrame:
    _, merge, schema = _TABLES[name]
    return merge(read_batches(spark, f"{base}/{name}", schema))


def read_ports(spark: SparkSession, base: str) -> DataFrame:
    """A10 from the stored rollup."""
    return _read(spark, base, "ports")


def read_suspicious_ips(spark: SparkSession, base: str, thresholds=A.DEFAULT_RISK_THRESHOLDS) -> DataFrame:
    """A11 from the stored rollup; the risk follows from the merged count."""
    return _read(spark, base, "blocked").withColumn("risk_level", A.risk_level(F.col("blocked_count"), thresholds))


def read_hours(spark: SparkSession, base: str) -> DataFrame:
    """A9 from the stored rollup; unique addresses are those of the sketches."""
    return _read(spark, base, "hours").select(
        *_HOUR_KEYS, F.col("events").alias("total_events"), F.coalesce("bytes", F.lit(0)).cast("bigint").alias("total_bytes"),
        (F.col("dur_sum") / F.col("dur_n")).alias("avg_duration_ms"),
        F.hll_sketch_estimate("src").alias("unique_src_ips"), F.hll_sketch_estimate("dst").alias("unique_dst_ips"))


def unique_addresses(spark: SparkSession, base: str, first: str | None = None, last: str | None = None,
                     by: tuple[str, ...] = ()) -> DataFrame:
    """Unique source and destination addresses of any range of hours (``first`` to before ``last``), also ``by`` some of
    firewall_id, protocol, action or the hour: from the sketches of the hours, however many records they had."""
    rows = read_batches(spark, f"{base}/hours", _TABLES["hours"][2])
    if first:
        rows = rows.where(F.col("hour_timestamp") >= F.lit(first).cast("timestamp"))
    if last:
        rows = rows.where(F.col("hour_timestamp") < F.lit(last).cast("timestamp"))
    estimate = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    return rows.groupBy(*by).agg(F.sum("events").alias("events"), estimate("src").alias("unique_src_ips"),
                                 estimate("dst").alias("unique_dst_ips"))
