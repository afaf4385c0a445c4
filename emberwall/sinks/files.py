"""Writers: landing zone, dedup table, classified CSV, curated table, cursor, progress (K1-K6)."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import CHUNK_BYTES
from ..operators.classify import drop_corrupt, to_curated
from ..operators.dedup import dedup_latest
from ..schemas import CURSOR_SCHEMA, PROGRESS_SCHEMA
from ..sources.jsonl import ingest_marked, with_partition_key
from ..sources.tables import read_curated
from .batches import file_system, folders, remove

DEDUP_TABLE_DDL = "id string, timestamp timestamp, ingest_ts timestamp, raw string, reason string, day string, batch string"
#: Last partition column of a stream's landing and of the dedup table: a batch that is run again replaces its own folders.
BATCH = "batch"
#: Day of the dedup table under which the lines are kept that it could not take.
REJECTED = "rejected"
#: Lines from whose lengths the mean is taken.
LENGTH_SAMPLE = 10_000


def mean_length(lines: DataFrame, value: str = "value") -> float | None:
    """Mean length in bytes of the first lines, newlines counted."""
    return lines.select(value).limit(LENGTH_SAMPLE).agg(F.avg(F.octet_length(value) + 1)).first()[0]


def part_records(lines: DataFrame, chunk_bytes: int, value: str = "value") -> int:
    """Records that make up ``chunk_bytes`` (Spark cuts files by record count)."""
    mean = mean_length(lines, value)
    return max(1, int(chunk_bytes / mean)) if mean else 0


def landing_write(lines: DataFrame, base: str, chunk_bytes: int = CHUNK_BYTES, value: str = "value",
                  compression: str | None = None, batch_id: int | str | None = None, again: bool = True,
                  mean_bytes: float | None = None) -> dict:
    """K1: original lines into ``base/dt=YYYY-MM-DD/hour=HH/part-*`` by event time (UTC).

    ``REBALANCE(dt, hour)`` clusters lines by partition so each folder gets
    few files, while adaptive execution splits a hot hour over several tasks
    (no single task ever holds a whole skewed hour) and merges tiny ones.
    Parts are cut at about ``chunk_bytes``, by ``mean_bytes`` a line or else by
    the length of the first lines.
    With ``batch_id`` the folders get a further level ``batch=N``; they are
    replaced if the batch may have been written before (``again``), which takes
    a move for each folder where a first delivery takes one for each day.
    Returns what was written: ``lines``, their ``mean`` length with newlines
    (None if there were none) and the ``hours`` (``dt=/hour=`` folders) written to.
    """
    only = lines.select(F.col(value).alias("value"))
    seen = Observation()
    keyed = with_partition_key(only).observe(
        seen, F.count("*").alias("lines"), F.avg(F.octet_length("value") + 1).alias("mean"),
        F.collect_set(F.concat(F.lit("dt="), F.col("dt"), F.lit("/hour="), F.col("hour"))).alias("hours"))
    dealt = keyed.hint("rebalance", "dt", "hour")
    if batch_id is None:
        writer = dealt.write.mode("append").partitionBy("dt", "hour")
    else:
        writer = (dealt.withColumn(BATCH, F.lit(str(batch_id))).write.mode("overwrite" if again else "append")
                  .option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hour", BATCH))
    records = part_records(only, chunk_bytes) if mean_bytes is None else max(1, int(chunk_bytes / mean_bytes))
    writer = writer.option("maxRecordsPerFile", records)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(base)
    return seen.get


def dedup_append(lines: DataFrame, table: str, value: str = "value", batch_id: int | str | None = None) -> None:
    """K2 write side: ``(id, timestamp, ingest_ts, raw)`` to a table of ``day=/batch=`` folders.

    Every line is parsed once and written once: those that cannot be used go,
    with the reason, to the table's ``day=rejected`` (see ``read_rejects``). A
    batch that is written again under its ``batch_id`` replaces its own folders,
    its rejects too; without one it is a batch of its own. Re-sent lines are
    harmless: the read side keeps the newest ``ingest_ts`` per ``(timestamp, id)``.
    """
    batch = uuid.uuid4().hex if batch_id is None else str(batch_id)
    rows = ingest_marked(lines, value).withColumns({
        "day": F.when(F.col("reason").isNull(), F.date_format("timestamp", "yyyyMMdd")).otherwise(F.lit(REJECTED)),
        BATCH: F.lit(batch)})
    (rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", BATCH).option("compression", "zstd").parquet(table))


def _dedup_rows(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(DEDUP_TABLE_DDL).parquet(table)


def read_dedup_table(spark: SparkSession, table: str, first_day: str | None = None,
                     last_day: str | None = None) -> DataFrame:
    """K2 read side: the raw rows (latest-wins applied by ``dedup_latest``, or see ``read_latest``).

    Days are ``yyyyMMdd``, inclusive; only their folders are read. All copies
    of a key have one timestamp and so one day.
    """
    rows = _dedup_rows(spark, table).where(F.col("day") != REJECTED)
    if first_day:
        rows = rows.where(F.col("day") >= first_day)
    if last_day:
        rows = rows.where(F.col("day") <= last_day)
    return rows.select("id", "timestamp", "ingest_ts", "raw")


def read_rejects(spark: SparkSession, table: str) -> DataFrame:
    """Lines that the dedup table could not take: (reason, raw)."""
    return _dedup_rows(spark, table).where(F.col("day") == REJECTED).select("reason", "raw")


def dedup_folders(spark: SparkSession, table: str) -> dict[str, list[str]]:
    """The batches of each day of a dedup table, from the names of its folders."""
    return {name[len("day="):]: [b[len("batch="):] for b in folders(spark, f"{table}/{name}") if b.startswith("batch=")]
            for name in folders(spark, table) if name.startswith("day=")}


def dedup_compact(spark: SparkSession, table: str) -> list[str]:
    """Merge the batches of every day touched since it was last merged into one of its latest versions.

    A day of one batch stays as it is, so what a run costs follows the days that
    have changed. The merged rows are a batch of their own, committed before
    the batches that went into it are removed: a reader or a run cut short in
    between meets rows twice, which latest-wins takes as replays, and the next
    run merges them. Rejects are merged to one of each. Batches that come in
    meanwhile stay for the next run. Returns the days merged.
    """
    found = {day: batches for day, batches in dedup_folders(spark, table).items()
             if len(batches) > 1 or not all(b.startswith(COMPACTED) for b in batches)}
    if not found:
        return []
    seen = F.col("day").isin(*found) & F.concat_ws("/", "day", BATCH).isin(
        *[f"{day}/{b}" for day, batches in found.items() for b in batches])
    rows = _dedup_rows(spark, table).where(seen)
    merged = dedup_latest(rows.where(F.col("day") != REJECTED).drop("reason", "day", BATCH)).withColumns(
        {"reason": F.lit(None).cast("string"), "day": F.date_format("timestamp", "yyyyMMdd")})
    none = {c: F.lit(None).cast(t) for c, t in (("id", "string"), ("timestamp", "timestamp"), ("ingest_ts", "timestamp"))}
    rejects = rows.where(F.col("day") == REJECTED).groupBy("reason", "raw").agg(F.count("*")).select(
        *[v.alias(c) for c, v in none.items()], "raw", "reason", F.lit(REJECTED).alias("day"))
    name = f"{COMPACTED}{uuid.uuid4().hex}"
    (merged.unionByName(rejects).withColumn(BATCH, F.lit(name)).hint("rebalance", "day").write.mode("append")
     .partitionBy("day", BATCH).option("compression", "zstd").parquet(table))
    for day, batches in found.items():
        for b in batches:
            remove(spark, f"{table}/day={day}/batch={b}")
    return sorted(found)


#: How the batches are called that ``dedup_compact`` writes.
COMPACTED = "merged-"


def read_latest(spark: SparkSession, table: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The latest version of every key. Days that are one merged batch hold just that and are read as they are;
    only days with more go through ``dedup_latest``."""
    days = {day: b for day, b in dedup_folders(spark, table).items() if day != REJECTED
            and (not first_day or day >= first_day) and (not last_day or day <= last_day)}
    clean = [day for day, b in days.items() if len(b) == 1 and b[0].startswith(COMPACTED)]
    touched = sorted(set(days) - set(clean))
    rows = _dedup_rows(spark, table)
    columns = ("id", "timestamp", "ingest_ts", "raw")
    plain = rows.where(F.col("day").isin(*clean)).select(*columns) if clean else None
    if clean and not touched:
        return plain
    merged = dedup_latest(rows.where(F.col("day").isin(*touched)).select(*columns)).select(*columns)
    return merged if plain is None else plain.unionByName(merged)


def write_classified_csv(classified: DataFrame, path: str) -> bool:
    """K3: drop corrupt rows, write header CSV; nothing is written for an empty result.

    Values are written as they are: spaces kept, quotes doubled (RFC 4180).
    The emptiness probe reads one row at most. Returns whether data was written.
    """
    kept = drop_corrupt(classified)
    if kept.isEmpty():
        return False
    (kept.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return True


def curated_write(classified: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """K6: classified rows into the curated Parquet table, partitioned by day.

    ``created_at`` is the write time; rows are clustered by day and sorted
    by ``(timestamp, id)`` inside files so min/max statistics skip row groups;
    bloom filters of the looked-up columns skip those that statistics cannot.
    """
    curated = to_curated(classified).withColumns({
        "created_at": F.current_timestamp(),
        "day": F.coalesce(F.date_format("timestamp", "yyyy-MM-dd"), F.lit("unknown")),
    })
    writer = (curated.hint("rebalance", "day").sortWithinPartitions("day", "timestamp", "id")
              .write.mode(mode).partitionBy("day").option("compression", "zstd"))
    for column in LOOKUP_COLUMNS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
    writer.parquet(path)
    return curated


#: Columns of the curated table that are looked up by value.
LOOKUP_COLUMNS = ("src_ip", "dst_ip", "session_id")


def lookup(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    """Rows of the curated table with a value in one of ``LOOKUP_COLUMNS``; row groups whose bloom filter or
    statistics rule it out are not read."""
    if column not in LOOKUP_COLUMNS:
        raise ValueError(f"look up one of {', '.join(LOOKUP_COLUMNS)}")
    return read_curated(spark, path).where(F.col(column) == F.lit(value))


def cursor_write(spark: SparkSession, table: str, ts: str, id_: str, component: str = "stream") -> None:
    """K4: append one cursor row (``updated_at`` = now); ``cursor_latest`` reads it back."""
    row = spark.createDataFrame([(component, ts, id_, None)], CURSOR_SCHEMA)
    row.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(table)


def progress_snapshot(spark: SparkSession, total_docs: int, parts_written: int, elapsed_sec: float,
                      updated_at: str | None = None) -> DataFrame:
    """K5: the progress document as a one-row frame."""
    rate = round(total_docs / max(elapsed_sec, 1), 1)
    stamp = updated_at or time.strftime("%Y-%m-%dT%H:%M:%S.000Z", time.gmtime())
    return spark.createDataFrame(
        [(int(total_docs), int(parts_written), round(float(elapsed_sec), 1), rate, stamp)], PROGRESS_SCHEMA
    )


def progress_json(snapshot: DataFrame) -> str:
    """K5: the snapshot as compact JSON text (one row)."""
    row = snapshot.first().asDict()
    return json.dumps(row, separators=(",", ":"))


def write_progress(spark: SparkSession, snapshot: dict, path: str) -> None:
    """K5: the progress document, one JSON line in the file ``path``; a reader meets the newest or the one before."""
    jvm = spark.sparkContext._jvm
    fs, place = file_system(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(snapshot, separators=(",", ":")).encode() + b"\n"))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(
        fs.makeQualified(new), fs.makeQualified(place), how)


ROLLUP_TABLES = ("firewall_stats_hourly", "firewall_top_ports", "firewall_suspicious_ips")


def write_rollup_tables(curated: DataFrame, base: str, thresholds=None, mode: str = "overwrite") -> dict[str, str]:
    """Build and store the three rollup tables the read API serves.

    The hourly table is partitioned by day (readers prune by time); the two
    small tables are rebalanced into a few files. Returns table -> path.
    """
    from ..operators import aggregates as A

    paths = {name: f"{base}/{name}" for name in ROLLUP_TABLES}
    hourly = A.hourly_rollup(curated).withColumn("day", F.date_format("hour_timestamp", "yyyy-MM-dd"))
    (hourly.hint("rebalance", "day").write.mode(mode).partitionBy("day")
     .option("compression", "zstd").parquet(paths["firewall_stats_hourly"]))
    A.top_ports_build(curated).hint("rebalance").write.mode(mode).parquet(paths["firewall_top_ports"])
    sus = A.suspicious_ips_build(curated, thresholds) if thresholds else A.suspicious_ips_build(curated)
    sus.hint("rebalance").write.mode(mode).parquet(paths["firewall_suspicious_ips"])
    return paths


def read_rollup_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One stored rollup table (partition column dropped)."""
    df = spark.read.parquet(f"{base}/{name}")
    return df.drop("day") if "day" in df.columns else df
