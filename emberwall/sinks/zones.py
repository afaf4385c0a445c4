"""Zone map of the curated table: what each day folder holds, and newest-first pages that read few of them.

The map is a small table next to the curated one, a row for each day, severity,
action and protocol with its number of rows and its earliest and latest time,
beside the number and size of the day's files when it was made. A day whose
files have changed since is counted anew where it matters, so a stale or
missing map costs time and never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DASHBOARD_PAGE_SIZE, PAGE_SIZE
from ..operators.search import filter_equals, page_logs, search_logs
from ..sources.tables import read_curated
from .batches import file_system, folders

ZONES_DDL = ("severity string, action string, protocol string, rows bigint, min_ts timestamp, max_ts timestamp, "
             "files bigint, bytes bigint, day string")
_KEYS = ("severity", "action", "protocol")
UNKNOWN = "unknown"


def zones_table(path: str) -> str:
    return f"{path.rstrip('/')}__zones"


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """(day, files, bytes) of a day-partitioned table; only names and sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.groupBy(F.regexp_extract("path", "/day=([^/]*)/[^/]*$", 1).alias("day")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone map of the curated table at ``path``; empty if there is none."""
    if not folders(spark, zones_table(path)):
        return spark.createDataFrame([], ZONES_DDL)
    return spark.read.schema(ZONES_DDL).parquet(zones_table(path))


def zone_rows(curated: DataFrame) -> DataFrame:
    """Rows and times of each (day, severity, action, protocol)."""
    return curated.groupBy("day", *_KEYS).agg(F.count("*").alias("rows"), F.min("timestamp").alias("min_ts"),
                                              F.max("timestamp").alias("max_ts"))


def refresh_zones(spark: SparkSession, path: str) -> list[str]:
    """Map the days whose files have changed since they were last mapped; returns them. Other days are not read."""
    known = read_zones(spark, path).groupBy("day").agg(F.max("files").alias("f"), F.max("bytes").alias("b"))
    found = day_files(spark, path)
    changed = found.join(known, "day", "left").where(~(F.col("files").eqNullSafe(F.col("f")) & F.col("bytes").eqNullSafe(F.col("b"))))
    days = [r["day"] for r in changed.select("day").orderBy("day").collect()]  # at most one a folder
    if days:
        rows = zone_rows(read_curated(spark, path).where(F.col("day").isin(*days)))
        (rows.join(found, "day").select(*_KEYS, "rows", "min_ts", "max_ts", "files", "bytes", "day").coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(zones_table(path)))
    return days


def newest_days(spark: SparkSession, path: str, need: int, severity: str | None = None, action: str | None = None,
                protocol: str | None = None, search: str | None = None) -> list[str]:
    """The newest days that are certain to hold the first ``need`` matching rows, newest first (no time comes first).

    Days are walked from the newest. The map tells how many rows match the
    equality filters; days that it does not know, or all that may hold a match
    where a text is searched for, are counted in groups that double in size.
    """
    def matching(days: list[str]) -> int:
        rows = read_curated(spark, path).where(F.col("day").isin(*days))
        return search_logs(filter_equals(rows, severity, action, protocol), search).limit(need).count()

    # one row a day, however much the days hold
    zones = read_zones(spark, path)
    fits: Column = F.lit(True)
    for name, value in zip(_KEYS, (severity, action, protocol), strict=True):
        if value:
            fits = fits & F.col(name).eqNullSafe(F.lit(value))
    told = {r["day"]: r for r in zones.groupBy("day").agg(
        F.coalesce(F.sum(F.when(fits, F.col("rows"))), F.lit(0)).alias("rows"), F.max("bytes").alias("bytes"),
        F.max("files").alias("files")).collect()}
    names = [f[len("day="):] for f in folders(spark, path) if f.startswith("day=")]
    chosen, certain, pending, group = [], 0, [], 1
    for day in sorted(names, key=lambda d: (d != UNKNOWN, [-ord(c) for c in d])):
        fs, place = file_system(spark, f"{path}/day={day}")
        files = [s.getLen() for s in fs.listStatus(place) if not s.getPath().getName().startswith(("_", "."))]
        zone = told.get(day)
        valid = zone is not None and zone["files"] == len(files) and zone["bytes"] == sum(files)
        if valid and not zone["rows"]:
            continue
        chosen.append(day)
        if valid and not search:
            certain += zone["rows"]
        else:
            pending.append(day)
        if len(pending) >= group:
            certain, pending, group = certain + matching(pending), [], group * 2
        if certain >= need:
            break
    return chosen


def newest_page(spark: SparkSession, path: str, skip: int = 0, limit: int = PAGE_SIZE, **filters) -> DataFrame:
    """T1 on the stored table: the page of ``page_logs``, read from the newest days that are certain to hold it."""
    days = newest_days(spark, path, skip + limit, **filters)
    rows = read_curated(spark, path).where(F.col("day").isin(*days) if days else F.lit(False))
    return page_logs(rows, skip, limit, **filters)


def newest_dashboard_page(spark: SparkSession, path: str, page: int = 0, size: int = DASHBOARD_PAGE_SIZE, **filters) -> DataFrame:
    """T2 on the stored table: the dashboard's page ``page`` of ``size`` rows."""
    return newest_page(spark, path, page * size, size, **filters)
