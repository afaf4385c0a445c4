"""ST7 with keyed state: the latest version of each key is held in a RocksDB state store.

Where the batch tables of ``jobs.stream_dedup`` store what every micro-batch
holds and resolve it when read, this stream knows what it has seen: it writes a
line only if it is newer than the version held, so a redelivered file adds
counts and no lines. Each task first collapses its own lines, so a key with
a third of all lines reaches its state as one row per Arrow batch. The state
has a row (time and line) for each key; a time to live given by the caller
bounds it. A key whose state has gone is written anew when it comes again,
which the read side resolves, so results do not depend on the time to live.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.dedup import dedup_latest
from ..sinks.batches import MERGE_EVERY, read_batches, write_and_merge
from ..sources.jsonl import ingest_marked
from .jobs import _run, line_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings that the stream takes when it starts. State whose time is over is let go by the next batch that has lines:
#: batches without any would follow one another for ever, and a bounded run would not end.
_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}

_KEYS = ("ts_us", "id", "reason", "digest")
_VERSION = "ingest_us long, raw string"
_SEEN = f"ts_us long, id string, reason string, digest string, {_VERSION}, seen long"
#: ``seen`` counts the key's lines of the batch (with a time to live), ``total`` those of all batches so far (without).
_CHANGE = f"{_SEEN}, total long"
#: Before any time, for lines that have none.
_NEVER = -(1 << 63)


def _newer(a: tuple, b: tuple | None) -> bool:
    """Whether version (ingest_us, raw) ``a`` comes after ``b``; ties of time go to the greater line."""
    def order(v):
        return (_NEVER if v[0] is None else v[0], v[1])

    return b is None or order(a) > order(b)


def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The newest version of each key of a batch, and how many lines it stands for."""
    for batch in batches:
        best, seen = {}, {}
        for *key, ingest_us, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            key = tuple(key)
            seen[key] = seen.get(key, 0) + 1
            if _newer((ingest_us, raw), best.get(key)):
                best[key] = (ingest_us, raw)
        rows = [(*k, *v, seen[k]) for k, v in best.items()]
        kinds = [*batch.schema.types, pa.int64()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "seen"])


class LatestVersion(StatefulProcessor):
    """Holds the newest version of a key; gives it out when it changes, and always the number of lines seen."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.held = handle.getValueState("latest", _VERSION, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - Spark's names
        best, seen = None, 0
        for r in rows:
            seen += r.seen
            if _newer((r.ingest_us, r.raw), best):
                best = (r.ingest_us, r.raw)
        known = self.held.get()
        if known is None or _newer(best, tuple(known)):
            self.held.update(best)
        else:
            best = (None, None)
        yield Row(**dict(zip(("ts_us", "id", "reason", "digest", "ingest_us", "raw", "seen"), (*key, *best, seen), strict=True)))

    def close(self) -> None:
        pass


def held_for_good(keyed: DataFrame) -> DataFrame:
    """A row per key and micro-batch by a running aggregate: the greatest version with the time of the batch that
    brought it first, and the lines so far. The version is given out by the batch that brought it."""
    now = -F.unix_micros(F.current_timestamp())  # one time for all of a batch, also if it runs again
    held = keyed.withColumn("brought", now).groupBy(*_KEYS).agg(
        F.max(F.struct("ingest_us", "raw", "brought")).alias("newest"), F.count("*").alias("total"))
    new = F.col("newest.brought") == now
    return held.select(*_KEYS, *[F.when(new, F.col(f"newest.{c}")).alias(c) for c in ("ingest_us", "raw")],
                       F.lit(None).cast("long").alias("seen"), "total")


def changes(lines: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The keyed stream: a row per key and micro-batch, with its line where that is newer than the one held.

    Without a time to live Spark's own running aggregate holds the keys; with one, which aggregates do not have,
    ``LatestVersion`` does.
    """
    keyed = ingest_marked(lines).select(
        F.unix_micros("timestamp").alias("ts_us"), "id", "reason",
        F.when(F.col("reason").isNotNull(), F.sha2("raw", 256)).alias("digest"),
        F.unix_micros("ingest_ts").alias("ingest_us"), "raw")
    if not ttl_ms:
        return held_for_good(keyed)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package
    return keyed.mapInArrow(collapsed, _SEEN).groupBy(*_KEYS).transformWithState(
        LatestVersion(ttl_ms), _SEEN, "update", "ProcessingTime").withColumn("total", F.lit(None).cast("long"))


def merged_changes(rows: DataFrame) -> DataFrame:
    """Changes of several batches as those of one: a key's newest version and all lines seen."""
    newest = F.max(F.struct("ingest_us", "raw")).alias("newest")
    return rows.groupBy(*_KEYS).agg(newest, F.sum("seen").alias("seen"), F.max("total").alias("total")).select(
        *_KEYS, "newest.ingest_us", "newest.raw", "seen", "total")


def stream_latest(spark: SparkSession, source: str, table: str, checkpoint: str, trigger: str | None = None,
                  max_files_per_trigger: int | None = None, wait: bool = True, max_bytes_per_trigger: str | None = None,
                  ttl_ms: int | None = None, merge_every: int | None = MERGE_EVERY) -> StreamingQuery:
    """ST7 by keyed state: one record per ``(timestamp, id)``, the one with the greatest ``ingest_ts``.

    ``ttl_ms`` lets the state of a key go so long (in processing time) after its
    last change; without it the state grows with the keys. Rejected lines are
    keys of their own and kept once.
    """
    lines = line_stream(spark, source, max_files_per_trigger, max_bytes_per_trigger)
    writer = changes(lines, ttl_ms).writeStream.outputMode("update").foreachBatch(
        lambda batch, bid: write_and_merge(batch, table, bid, _CHANGE, merged_changes, merge_every or 0))
    before = {name: spark.conf.get(name) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return _run(writer, checkpoint, trigger, wait)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_stream_latest(spark: SparkSession, table: str) -> DataFrame:
    """Read side: the latest version of each key over all batches."""
    rows = read_batches(spark, table, _CHANGE).where(F.col("raw").isNotNull() & F.col("reason").isNull())
    return dedup_latest(rows.select("id", F.timestamp_micros("ts_us").alias("timestamp"),
                                    F.timestamp_micros("ingest_us").alias("ingest_ts"), "raw"))


def read_latest_rejects(spark: SparkSession, table: str) -> DataFrame:
    """Lines that the stream could not use, one of each: (reason, raw)."""
    rows = read_batches(spark, table, _CHANGE).where(F.col("raw").isNotNull() & F.col("reason").isNotNull())
    return rows.groupBy("reason", "digest").agg(F.first("raw").alias("raw")).select("reason", "raw")


def read_latest_counts(spark: SparkSession, table: str) -> DataFrame:
    """One row: usable lines, the keys they come to, lines that gave way to another of their key, and rejected lines."""
    usable = F.col("reason").isNull()
    lines_of = F.coalesce(F.sum("seen"), F.lit(0)) + F.coalesce(F.max("total"), F.lit(0))
    by_key = read_batches(spark, table, _CHANGE).groupBy(*_KEYS).agg(lines_of.alias("seen"))
    lines, kept = F.coalesce(F.sum(F.when(usable, F.col("seen"))), F.lit(0)), F.count_if(usable)
    return by_key.agg(lines.alias("lines"), kept.alias("keys"), (lines - kept).alias("dropped"),
                      F.coalesce(F.sum(F.when(~usable, F.col("seen"))), F.lit(0)).alias("rejected"))
