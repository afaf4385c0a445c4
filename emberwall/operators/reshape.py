"""Set and reshape operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_endpoints(logs: DataFrame) -> DataFrame:
    """One row per (record, source|destination) with ``endpoint, ip, port``.

    A single scan: both endpoints come out of one ``inline`` generator, so
    the input is read once and no union plan duplicates the scan.
    """
    pairs = F.array(
        F.struct(F.lit("source").alias("endpoint"), F.col("src_ip").alias("ip"),
                 F.col("src_port").alias("port")),
        F.struct(F.lit("destination").alias("endpoint"), F.col("dst_ip").alias("ip"),
                 F.col("dst_port").alias("port")),
    )
    keep = [c for c in logs.columns if c not in ("src_ip", "dst_ip", "src_port", "dst_port")]
    return logs.select(*keep, F.inline(pairs))
