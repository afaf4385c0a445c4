"""Structured Streaming jobs (ST1-ST7).

Each job reads a folder of JSON-lines files as a file stream, keeps its
progress in a checkpoint folder (restart resumes exactly where it stopped)
and writes through an exactly-once file sink or an idempotent
``foreachBatch``. ``trigger="availableNow"`` reproduces the reference's
bounded run: everything present is processed, then the query stops.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.classify import analyze_batch, to_curated
from ..schemas import RAW_SCHEMA
from ..functions.constants import CHUNK_BYTES
from ..operators.dedup import dedup_latest
from ..sinks.batches import MERGE_EVERY, file_system, folders, read_batches, stream_id, write_and_merge
from ..sinks.files import dedup_append, dedup_compact, landing_write, mean_length
from ..sinks.manifest import note_batch
from ..sources.jsonl import ingest_marked, parsed_once, scan_jsonl
from .records import record_stream


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


_LOG_WRITER = "spark.sql.streaming.checkpointFileManagerClass"
#: Writes a checkpoint's logs through Hadoop's file systems, as Spark does where those have no file contexts.
_PLAIN_LOGS = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def _start(spark: SparkSession, writer, checkpoint: str, plain_logs: bool) -> StreamingQuery:
    """With ``plain_logs`` a checkpoint on a disk gets its two log entries a batch without a file context, which starts
    several processes for each file (to read links and set rights); a stream makes its logs when it starts."""
    before = spark.conf.get(_LOG_WRITER, None)
    if not plain_logs or before is not None or file_system(spark, checkpoint)[0].getScheme() != "file":
        return writer.start()
    spark.conf.set(_LOG_WRITER, _PLAIN_LOGS)
    try:
        return writer.start()
    finally:
        spark.conf.unset(_LOG_WRITER)


def _run(writer, checkpoint: str, trigger: str | None, wait: bool, by_records: bool = False) -> StreamingQuery:
    spark, writer = writer._spark, writer.option("checkpointLocation", checkpoint)
    if by_records and trigger is None:
        # "available now" would take one batch of a source that says how far it goes batch by batch
        q = _start(spark, writer.trigger(processingTime="0 seconds"), checkpoint, True)
        if wait:
            q.processAllAvailable()
            q.stop()
        return q
    q = _start(spark, _trigger(writer, trigger), checkpoint, by_records)
    if wait:
        q.awaitTermination()
    return q


def _label(batch: DataFrame, batch_id: int) -> str:
    """A micro-batch's name, its own among all streams that write to one place."""
    return f"{stream_id(batch.sparkSession) or 'batch'}-{batch_id}"


def line_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: str | None = None, max_records_per_trigger: int | None = None) -> DataFrame:
    """ST1/ST3 source: lines of new files under ``source``.

    Rate limiting (ST3) is source admission, not sleeping: at most
    ``max_files_per_trigger`` files (or about ``max_bytes_per_trigger``) enter
    each micro-batch; with a processing-time trigger this caps the rate.
    ``max_records_per_trigger`` admits an exact number of records instead (see
    ``records``): 8,200 with a trigger of one second is the reference's rate.
    """
    if max_records_per_trigger:
        return record_stream(spark, source, max_records_per_trigger)
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(source)


def stream_landing(spark: SparkSession, source: str, base: str, checkpoint: str, trigger: str | None = None,
                   max_files_per_trigger: int | None = None, wait: bool = True,
                   max_bytes_per_trigger: str | None = None, chunk_bytes: int = CHUNK_BYTES,
                   max_records_per_trigger: int | None = None) -> StreamingQuery:
    """ST1: lines into the ``dt=/hour=`` landing zone, each micro-batch by the batch writer (K1).

    A batch is clustered by hour and cut into parts by bytes; one that is
    delivered again replaces its own ``batch=N`` folders, so lines land once.
    Each batch is noted in the zone's manifest. The length of lines is the mean of the batch before, at first that of a few lines of the source.
    """
    # only the first batch of a run can have been written before, by a run that was cut short
    state = {"again": bool(folders(spark, base)), "mean": None}

    def land(batch: DataFrame, batch_id: int) -> None:
        if state["mean"] is None:  # beside the stream, whose input is thus read once
            state["mean"] = mean_length(scan_jsonl(batch.sparkSession, source))
        wrote = landing_write(batch, base, chunk_bytes, batch_id=_label(batch, batch_id), again=state["again"],
                              mean_bytes=state["mean"])
        state.update(again=False, mean=wrote.get("mean") or state["mean"])
        label = _label(batch, batch_id)
        note_batch(batch.sparkSession, base, label.rsplit("-", 1)[0], batch_id, wrote.get("lines") or 0,
                   [f"{base}/{hour}/batch={label}" for hour in wrote.get("hours") or ()])

    lines = line_stream(spark, source, max_files_per_trigger, max_bytes_per_trigger, max_records_per_trigger)
    return _run(lines.writeStream.foreachBatch(land), checkpoint, trigger, wait, bool(max_records_per_trigger))


def stream_upsert(spark: SparkSession, source: str, table: str, checkpoint: str, trigger: str | None = None,
                  max_files_per_trigger: int | None = None, wait: bool = True,
                  max_bytes_per_trigger: str | None = None,
                  merge_every: int | None = MERGE_EVERY, max_records_per_trigger: int | None = None) -> StreamingQuery:
    """ST2: lines into the dedup table through ``foreachBatch``; unusable ones into its rejects.

    A batch that is delivered again replaces its own folders; re-sent lines are
    resolved by the latest-wins read side. Every ``merge_every`` batches the
    days touched since are merged (``dedup_compact``); one stream at a time may do so.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        dedup_append(batch, table, batch_id=_label(batch, batch_id))
        if merge_every and batch_id % merge_every == merge_every - 1:
            dedup_compact(batch.sparkSession, table)

    lines = line_stream(spark, source, max_files_per_trigger, max_bytes_per_trigger, max_records_per_trigger)
    return _run(lines.writeStream.foreachBatch(upsert), checkpoint, trigger, wait, bool(max_records_per_trigger))


_RECORD_FIELDS = ", ".join(f"{f.name} string" for f in RAW_SCHEMA.fields)


def parse_records(lines: DataFrame) -> DataFrame:
    """JSON firewall records (one per line) as raw text columns, each line parsed once; ``rejected`` has the line
    where it is not strict JSON (and then the columns are null)."""
    parsed = parsed_once(lines.select("value"), "value", _RECORD_FIELDS)
    return parsed.select("j.*", F.when(F.col("j").isNull(), F.col("value")).alias("rejected"))


def _records(lines: DataFrame) -> DataFrame:
    """The records of the lines that are strict JSON."""
    return parse_records(lines).where(F.col("rejected").isNull()).drop("rejected")


#: Partition columns of a classified stream: rows or rejects, and the batch.
ROWS, REJECTS = "rows", "rejects"


def write_classified(batch: DataFrame, batch_id: int | str, out: str, timestamp_mode: str = "parsed") -> None:
    """Classified records of one micro-batch and, apart, the lines that are not strict JSON; one parse, one write.

    A batch that is delivered again replaces its own folders.
    """
    records = parse_records(batch)
    classified = analyze_batch(records, timestamp_mode)
    fine = F.col("rejected").isNull()
    kept = [F.when(fine, F.col(c)).alias(c) for c in classified.columns if c != "rejected"]
    (classified.select(*kept, "rejected", F.when(fine, ROWS).otherwise(REJECTS).alias("kind"), F.lit(str(batch_id)).alias("batch"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch")
     .option("compression", "zstd").parquet(out))


def read_classified(spark: SparkSession, out: str) -> DataFrame:
    """ST5 read side: the classified records."""
    return spark.read.parquet(out).where(F.col("kind") == ROWS).drop("kind", "batch", "rejected")


def read_classified_rejects(spark: SparkSession, out: str) -> DataFrame:
    """Lines of a classified stream that are not strict JSON: (reason, raw)."""
    return spark.read.parquet(out).where(F.col("kind") == REJECTS).select(
        F.lit("bad_json").alias("reason"), F.col("rejected").alias("raw"))


def stream_classify(spark: SparkSession, source: str, out: str, checkpoint: str, trigger: str | None = None,
                    timestamp_mode: str = "parsed", max_files_per_trigger: int | None = None,
                    wait: bool = True) -> StreamingQuery:
    """ST5: the batch classifier on a stream (stateless, so it applies unchanged); bad lines are kept as rejects."""
    lines = line_stream(spark, source, max_files_per_trigger)
    writer = lines.writeStream.foreachBatch(lambda batch, bid: write_classified(batch, _label(batch, bid), out, timestamp_mode))
    return _run(writer, checkpoint, trigger, wait)


_ROLLUP_KEYS = ("hour_timestamp", "firewall_id", "protocol", "action")


_PARTIALS_SCHEMA = (
    "hour_timestamp timestamp, firewall_id string, protocol string, action string, kind string, ip string, "
    "events bigint, bytes bigint, dur_sum bigint, dur_n bigint"
)


def rollup_partials(curated: DataFrame) -> DataFrame:
    """Per-batch pieces of the hourly rollup: measures plus distinct endpoint addresses.

    ``kind='m'`` rows carry the additive measures; ``kind='s'/'d'`` rows are
    the distinct source / destination addresses seen per key. Both are
    pre-aggregated inside the micro-batch, so a batch emits at most one row
    per key and address.
    """
    keyed = curated.where(
        F.col("timestamp").isNotNull() & F.col("firewall_id").isNotNull()
        & F.col("protocol").isNotNull() & F.col("action").isNotNull()
    ).withColumn("hour_timestamp", F.date_trunc("hour", "timestamp"))
    # one pass: each record as its measures and as its two addresses, grouped by kind and address
    pieces = keyed.select(*_ROLLUP_KEYS, F.inline(F.array(
        F.struct(F.lit("m").alias("kind"), F.lit(None).cast("string").alias("ip"), F.lit(1).alias("one"),
                 F.col("bytes").alias("bytes"), F.col("duration_ms").alias("ms")),
        *[F.struct(F.lit(k).alias("kind"), F.col(c).alias("ip"), F.lit(None).cast("int").alias("one"),
                   F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("int").alias("ms"))
          for k, c in (("s", "src_ip"), ("d", "dst_ip"))],
    ))).where((F.col("kind") == "m") | F.col("ip").isNotNull())
    return pieces.groupBy(*_ROLLUP_KEYS, "kind", "ip").agg(
        F.count("one").alias("events"), F.sum("bytes").alias("bytes"), F.sum("ms").cast("bigint").alias("dur_sum"),
        F.count("ms").alias("dur_n"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Pieces of several batches as the pieces of one: a row for each key and address."""
    return partials.groupBy(*_ROLLUP_KEYS, "kind", "ip").agg(
        *[F.sum(c).alias(c) for c in ("events", "bytes", "dur_sum", "dur_n")])


def write_partials(batch: DataFrame, batch_id: int, table: str, merge_every: int | None = MERGE_EVERY) -> None:
    """Idempotent: a replayed batch replaces only its own folder; every ``merge_every`` batches all are merged."""
    write_and_merge(rollup_partials(batch), table, batch_id, _PARTIALS_SCHEMA, merge_partials, merge_every or 0)


def read_hourly_rollup(spark: SparkSession, table: str) -> DataFrame:
    """ST6 read side: exact hourly rollup from the accumulated partials."""
    p = read_batches(spark, table, _PARTIALS_SCHEMA)
    is_m = F.col("kind") == "m"
    return p.groupBy(*_ROLLUP_KEYS).agg(
        F.sum(F.when(is_m, F.col("events"))).cast("bigint").alias("total_events"),
        F.coalesce(F.sum(F.when(is_m, F.col("bytes"))), F.lit(0)).cast("bigint").alias("total_bytes"),
        (F.sum(F.when(is_m, F.col("dur_sum"))) / F.sum(F.when(is_m, F.col("dur_n")))).alias("avg_duration_ms"),
        F.count_distinct(F.when(F.col("kind") == "s", F.col("ip"))).alias("unique_src_ips"),
        F.count_distinct(F.when(F.col("kind") == "d", F.col("ip"))).alias("unique_dst_ips"),
    )


def stream_hourly_rollup(spark: SparkSession, source: str, table: str, checkpoint: str,
                         trigger: str | None = None, max_files_per_trigger: int | None = None,
                         wait: bool = True, merge_every: int | None = MERGE_EVERY) -> StreamingQuery:
    """ST6: incremental hourly rollup (exact distinct counts, no unbounded state).

    Records are classified and typed on the stream (lines that are not strict
    JSON have no key and count nowhere), each micro-batch writes its
    pre-aggregated partials, and ``read_hourly_rollup`` merges them; every
    ``merge_every`` batches they are merged where they are stored.
    Late records simply add partials to their old hour, as the reference
    lands late records in their old partition.
    """
    curated = to_curated(analyze_batch(_records(line_stream(spark, source, max_files_per_trigger))))
    writer = curated.writeStream.foreachBatch(lambda b, bid: write_partials(b, bid, table, merge_every))
    return _run(writer, checkpoint, trigger, wait)


def distinct_about(column: str, rsd: float) -> Column:
    """Distinct values, with a relative standard error of ``rsd``. A sketch of few values is a list of them: what is
    dealt out and held follows the values of a group, where HLL++ takes its full size (13 KB for 0.01) for each."""
    bits = min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))
    # sketches pass over empty values
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.concat(F.lit("="), F.col(column)), bits))


def windowed_hourly_rollup(curated_stream: DataFrame, watermark: str | None = None, rsd: float = 0.01) -> DataFrame:
    """ST6, stateful variant for live dashboards: event-time windows, in update mode.

    Without a ``watermark`` every record counts, however late, and the state
    has a row for each hour, firewall, protocol and action seen. A watermark
    bounds the state and gives up records later than it. Distinct counts are
    HLL sketches (exact distinct is not supported on streams).
    """
    if watermark:
        curated_stream = curated_stream.withWatermark("timestamp", watermark)
    return (
        curated_stream
        .groupBy(F.window("timestamp", "1 hour"), "firewall_id", "protocol", "action")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
            F.avg("duration_ms").alias("avg_duration_ms"),
            distinct_about("src_ip", rsd).alias("unique_src_ips"),
            distinct_about("dst_ip", rsd).alias("unique_dst_ips"),
        )
        .withColumn("hour_timestamp", F.col("window.start"))
        .drop("window")
    )


_LATEST_SCHEMA = "timestamp timestamp, id string, reason string, digest string, ingest_ts timestamp, raw string"
_LATEST_KEYS = ("timestamp", "id", "reason", "digest")


def latest_or_rejected(marked: DataFrame) -> DataFrame:
    """The latest version of each key, and one of each rejected line (its key is its digest)."""
    return dedup_latest(marked, keys=_LATEST_KEYS)


def write_latest(batch: DataFrame, batch_id: int, table: str, merge_every: int | None = MERGE_EVERY) -> None:
    """Latest version of each key in one micro-batch and its rejected lines, in a folder of its own (idempotent per id)."""
    marked = ingest_marked(batch).withColumn("digest", F.when(F.col("reason").isNotNull(), F.sha2("raw", 256)))
    write_and_merge(latest_or_rejected(marked), table, batch_id, _LATEST_SCHEMA, latest_or_rejected, merge_every or 0)


def read_stream_dedup(spark: SparkSession, table: str) -> DataFrame:
    """ST7 read side: the latest version of each key over all batches."""
    rows = read_batches(spark, table, _LATEST_SCHEMA).where(F.col("reason").isNull())
    return dedup_latest(rows.select("id", "timestamp", "ingest_ts", "raw"))


def read_stream_rejects(spark: SparkSession, table: str) -> DataFrame:
    """Lines that ST7 could not use, one of each: (reason, raw)."""
    rows = read_batches(spark, table, _LATEST_SCHEMA).where(F.col("reason").isNotNull())
    return rows.groupBy("reason", "digest").agg(F.first("raw").alias("raw")).select("reason", "raw")


def stream_dedup(spark: SparkSession, source: str, table: str, checkpoint: str, trigger: str | None = None,
                 max_files_per_trigger: int | None = None, wait: bool = True,
                 max_bytes_per_trigger: str | None = None, merge_every: int | None = MERGE_EVERY) -> StreamingQuery:
    """ST7: one record per ``(timestamp, id)``, the one with the greatest ``ingest_ts``.

    Each micro-batch stores its own latest versions and the read side resolves
    them, so nothing is given up for being late and there is no state to bound;
    every ``merge_every`` batches the stored versions are merged. Lines that
    cannot be used are kept beside them (``read_stream_rejects``).
    """
    lines = line_stream(spark, source, max_files_per_trigger, max_bytes_per_trigger)
    writer = lines.writeStream.foreachBatch(lambda batch, bid: write_latest(batch, bid, table, merge_every))
    return _run(writer, checkpoint, trigger, wait)


_WINDOW_SCHEMA = (
    "hour_timestamp timestamp, firewall_id string, protocol string, action string, version bigint, total_events bigint, "
    "total_bytes bigint, avg_duration_ms double, unique_src_ips bigint, unique_dst_ips bigint"
)


def newest_windows(updates: DataFrame) -> DataFrame:
    """The newest state of every window key."""
    vals = [c for c in updates.columns if c not in _ROLLUP_KEYS and c != "version"]
    best = F.max(F.struct("version", *vals)).alias("b")
    return updates.groupBy(*_ROLLUP_KEYS).agg(best).select(*_ROLLUP_KEYS, *[F.col(f"b.{c}").alias(c) for c in ("version", *vals)])


def write_window_updates(batch: DataFrame, batch_id: int, table: str, merge_every: int | None = MERGE_EVERY) -> None:
    """Update-mode rows of one micro-batch, in a folder of its own (idempotent per id)."""
    rows = batch.withColumns({"version": F.lit(int(batch_id)).cast("bigint"), "total_bytes": F.col("total_bytes").cast("bigint")})
    write_and_merge(rows, table, batch_id, _WINDOW_SCHEMA, newest_windows, merge_every or 0)


def read_window_rollup(spark: SparkSession, table: str) -> DataFrame:
    """The newest state of every window key across all update batches."""
    return newest_windows(read_batches(spark, table, _WINDOW_SCHEMA)).drop("version")


def stream_window_rollup(spark: SparkSession, source: str, table: str, checkpoint: str,
                         watermark: str | None = None, trigger: str | None = None,
                         max_files_per_trigger: int | None = None, wait: bool = True) -> StreamingQuery:
    """ST6, event-time variant: hourly tumbling window, update mode.

    Each micro-batch emits the windows it changed; they are stored per batch
    id and ``read_window_rollup`` keeps the newest state per window. Only an
    explicit ``watermark`` gives up late records.
    """
    records = _records(line_stream(spark, source, max_files_per_trigger))
    curated = to_curated(analyze_batch(records)).where(
        F.col("timestamp").isNotNull() & F.col("firewall_id").isNotNull()
        & F.col("protocol").isNotNull() & F.col("action").isNotNull()
    )
    writer = (windowed_hourly_rollup(curated, watermark).writeStream.outputMode("update")
              .foreachBatch(lambda b, bid: write_window_updates(b, bid, table)))
    return _run(writer, checkpoint, trigger, wait)
