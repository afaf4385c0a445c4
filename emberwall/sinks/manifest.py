"""Commit log of a streamed landing zone: what each micro-batch has landed.

One row for each batch, under the stream that wrote it, added after its files
are in place and replaced if the batch runs again; rows are merged as the
stream goes on. Inventory and progress read it and never list the zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import folders, read_batches, write_and_merge

MANIFEST_DDL = "last_batch bigint, batches bigint, lines bigint, bytes bigint, files bigint"


def manifest_table(base: str) -> str:
    return f"{base.rstrip('/')}__manifest"


def total(rows: DataFrame) -> DataFrame:
    """Rows of several batches, or merged ones, as one."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("batches", "lines", "bytes", "files")]
    return rows.agg(F.max("last_batch").alias("last_batch"), *sums)


def note_batch(spark: SparkSession, base: str, stream: str, batch_id: int, lines: int, paths: list[str]) -> None:
    """Add a batch: ``paths`` are the folders it wrote, and all that is listed."""
    row = spark.range(0) if not paths else spark.read.format("binaryFile").load(paths)
    size = F.lit(0) if not paths else F.coalesce(F.sum("length"), F.lit(0))
    counted = row.agg(F.lit(int(batch_id)).cast("bigint").alias("last_batch"), F.lit(1).cast("bigint").alias("batches"),
                      F.lit(int(lines)).cast("bigint").alias("lines"), size.cast("bigint").alias("bytes"),
                      F.count("*").alias("files"))
    write_and_merge(counted, f"{manifest_table(base)}/stream={stream}", batch_id, MANIFEST_DDL, total)


def manifest_totals(spark: SparkSession, base: str) -> DataFrame:
    """Batches, lines, bytes and files landed so far, over all streams into the zone; one row."""
    root = manifest_table(base)
    found = spark.createDataFrame([], MANIFEST_DDL)
    for name in folders(spark, root):
        found = found.unionByName(read_batches(spark, f"{root}/{name}", MANIFEST_DDL))
    return total(found).drop("last_batch")
