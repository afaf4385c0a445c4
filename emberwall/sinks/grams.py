"""Text search that skips files (P21): which three-letter parts the searched columns of each file have.

The index is a small table next to the curated one: for each file a bitmap of
32,768 bits, one for every hash of three neighbouring characters (lower-cased)
of its values. A text can only be in a file that has all parts of it. Files
that the index does not know are read, so a stale or missing index costs time
and never rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.search import SEARCH_COLUMNS, search_logs
from ..sources.tables import read_curated
from .batches import folders

GRAMS_DDL = "file string, bits binary"
GRAM, BITS = 3, 32768


def grams_table(path: str) -> str:
    return f"{path.rstrip('/')}__grams"


def _bit(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BITS))


def _name(path: Column) -> Column:
    """A file by its day folder and name, however the path to the table is written."""
    return F.regexp_extract(path, "/(day=[^/]*/[^/]*)$", 1)


def file_grams(rows: DataFrame) -> DataFrame:
    """(file, bits) of the rows of a curated table."""
    values = rows.select(_name(F.col("_metadata.file_path")).alias("file"),
                         F.explode(F.array_distinct(F.array(*[F.lower(c) for c in SEARCH_COLUMNS]))).alias("value"))
    values = values.where(F.length("value") >= GRAM).distinct()
    places = F.sequence(F.lit(1), F.length("value") - (GRAM - 1))
    bits = values.select("file", F.explode(F.array_distinct(F.transform(
        places, lambda i: _bit(F.substring("value", i, F.lit(GRAM)))))).alias("bit"))
    # bit positions count from 0 within the one bucket that 32,768 bits are
    return bits.groupBy("file").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return listed.select("path", _name(F.col("path")).alias("file"))


def read_grams(spark: SparkSession, path: str) -> DataFrame:
    if not folders(spark, grams_table(path)):
        return spark.createDataFrame([], GRAMS_DDL)
    return spark.read.schema(GRAMS_DDL).parquet(grams_table(path))


def refresh_grams(spark: SparkSession, path: str) -> int:
    """Index the files that are not indexed yet (files never change once written); returns their number."""
    new = [r["path"] for r in _files(spark, path).join(read_grams(spark, path), "file", "left_anti").select("path").collect()]
    if new:
        rows = spark.read.schema(read_curated(spark, path).schema).option("basePath", path).parquet(*new)
        known = file_grams(rows)
        empty = _files(spark, path).where(F.col("path").isin(*new)).join(known, "file", "left_anti").select(
            "file", F.lit(None).cast("binary").alias("bits"))
        known.unionByName(empty).coalesce(1).withColumn("added", F.lit(len(new))).write.mode("append").partitionBy("added").parquet(
            grams_table(path))
    return len(new)


def needed_grams(text: str) -> list[str]:
    """Parts that every match of an ILIKE search for ``text`` has; wildcards part the text, an escape gives none."""
    if "\\" in text:
        return []
    parts = re.split("[%_]", text.lower())
    return sorted({p[i: i + GRAM] for p in parts for i in range(len(p) - GRAM + 1)})


def _has(gram: str) -> Column:
    """Whether a file's bitmap (null: a file without any text) has the bit of a part."""
    bit = _bit(F.lit(gram))
    byte = F.conv(F.hex(F.call_function("substring", F.col("bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def search_files(spark: SparkSession, path: str, text: str) -> list[str]:
    """Files that may hold a match; their names are what Spark's driver lists for any scan."""
    grams = read_grams(spark, path)
    without = grams.select("file").limit(0)
    if needed_grams(text):
        fits = F.lit(True)
        for gram in needed_grams(text):
            fits = fits & _has(gram)
        without = grams.where(~fits).select("file")
    return sorted(r["path"] for r in _files(spark, path).join(without, "file", "left_anti").select("path").collect())


def search_table(spark: SparkSession, path: str, text: str) -> DataFrame:
    """P21 on the stored table: the rows of ``search_logs``, read from the files that may hold them."""
    schema = read_curated(spark, path).schema
    files = search_files(spark, path, text)
    if not files:
        return spark.createDataFrame([], schema)
    return search_logs(spark.read.schema(schema).option("basePath", path).parquet(*files), text)
