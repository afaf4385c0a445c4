"""Streaming jobs: restart from checkpoint, replay idempotency, stream = batch."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from emberwall.fixtures import fw_raw, log_lines
from emberwall.operators.aggregates import hourly_rollup
from emberwall.operators.classify import analyze_batch, to_curated
from emberwall.operators.dedup import dedup_latest
from emberwall.session import shared_dir
from emberwall.sinks.files import read_dedup_table, write_progress
from emberwall.sinks.manifest import manifest_totals
from emberwall.sources.jsonl import ingest_project, landing_inventory, scan_landing
from emberwall.streaming import jobs as ST
from emberwall.streaming.progress import BATCHES_KEPT, ProgressCollector, watched


def _split_sources(spark, src):
    lines = log_lines(spark, SF001)
    first = lines.where(F.crc32("value") % 2 == 0)
    second = lines.where(F.crc32("value") % 2 == 1)
    first.write.text(f"{src}/a")
    return lines, second


def test_landing_restart_is_exactly_once(spark):
    src = shared_dir(spark, "t-src")
    lines, second = _split_sources(spark, src)
    base, ckpt = shared_dir(spark, "t-land"), shared_dir(spark, "t-ckpt")
    ST.stream_landing(spark, src, base, ckpt)
    second.write.text(f"{src}/b")                    # new files arrive after the first run
    ST.stream_landing(spark, src, base, ckpt)        # restart on the same checkpoint
    ST.stream_landing(spark, src, base, ckpt)        # and once more with nothing new
    landed = scan_landing(spark, base)
    assert landed.count() == lines.count()
    assert landed.select("value").exceptAll(lines).count() == 0


def test_upsert_replay_is_idempotent(spark):
    src = shared_dir(spark, "t-src")
    lines = log_lines(spark, SF001)
    lines.write.text(src)
    table = shared_dir(spark, "t-dedup")
    ST.stream_upsert(spark, src, table, shared_dir(spark, "t-ckpt"))
    ST.stream_upsert(spark, src, table, shared_dir(spark, "t-ckpt2"))   # full redelivery
    got = dedup_latest(read_dedup_table(spark, table))
    want = dedup_latest(ingest_project(lines))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_rate_limit_admits_one_file_per_batch(spark):
    src = shared_dir(spark, "t-src")
    log_lines(spark, SF001).repartition(3).write.text(src)
    collector = ProgressCollector()
    q = watched(spark, lambda: ST.stream_landing(spark, src, shared_dir(spark, "t-land"), shared_dir(spark, "t-ckpt"),
                                                 max_files_per_trigger=1), collector)
    assert collector.totals(str(q.id)) == (log_lines(spark, SF001).count(), 3)


def test_progress_snapshots_and_document(spark):
    src, base = shared_dir(spark, "t-src"), shared_dir(spark, "t-land")
    log_lines(spark, SF001).repartition(2).write.text(src)
    document, snaps = shared_dir(spark, "t-doc"), []

    def write(snap):
        snaps.append(snap)
        write_progress(spark, snap, document)

    collector = ProgressCollector(every_docs=500, on_snapshot=write,
                                  count_parts=lambda: manifest_totals(spark, base).first()["files"])
    watched(spark, lambda: ST.stream_landing(spark, src, base, shared_dir(spark, "t-ckpt"), max_files_per_trigger=1),
            collector)
    total = log_lines(spark, SF001).count()
    assert len(snaps) >= 2 and snaps[-1]["total_docs"] == total
    assert snaps[-1]["parts_written"] == landing_inventory(spark, base).first()["files"]
    stored = json.loads(spark.read.text(document).first()[0])
    assert stored["total_docs"] == total and set(stored) == {"total_docs", "parts_written", "elapsed_sec", "rate_rps", "updated_at"}
    assert len(collector.batches) <= BATCHES_KEPT
    told, listed = manifest_totals(spark, base).first(), landing_inventory(spark, base).first()
    assert (told.batches, told.lines, told.files, told.bytes) == (2, total, listed["files"], listed["total_bytes"])


def test_a_failing_progress_write_only_warns():
    def fail(_snap):
        raise OSError("full")

    collector = ProgressCollector(on_snapshot=fail)
    with pytest.warns(UserWarning, match="full"):
        collector._emit("q")


@pytest.mark.parametrize("files", [4, 2, 1])
def test_results_do_not_depend_on_how_files_are_batched(spark, files):
    src, fw = shared_dir(spark, "t-src"), shared_dir(spark, "t-fw")
    lines, raw = log_lines(spark, SF001), fw_raw(spark, SF001)
    lines.repartition(4).write.text(src)
    raw.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in raw.columns])).alias("value")).repartition(4).write.text(fw)

    def run(job, source, purpose):
        out = shared_dir(spark, purpose)
        job(spark, source, out, shared_dir(spark, "t-ckpt"), max_files_per_trigger=files)
        return out

    want = dedup_latest(ingest_project(lines))
    for got in (ST.read_stream_dedup(spark, run(ST.stream_dedup, src, "t-st7")),
                dedup_latest(read_dedup_table(spark, run(ST.stream_upsert, src, "t-st2")))):
        assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0
    landed = scan_landing(spark, run(ST.stream_landing, src, "t-st1"))
    assert landed.count() == lines.count()
    classified = ST.read_classified(spark, run(ST.stream_classify, fw, "t-st5"))
    assert classified.count() == raw.count()
    curated = to_curated(analyze_batch(raw))
    rollup = hourly_rollup(curated)
    exact = ST.read_hourly_rollup(spark, run(ST.stream_hourly_rollup, fw, "t-st6"))
    assert exact.select(*rollup.columns).exceptAll(rollup).count() == 0 and exact.count() == rollup.count()
    keys = ["hour_timestamp", "firewall_id", "protocol", "action", "total_events", "total_bytes"]
    windows = ST.read_window_rollup(spark, run(ST.stream_window_rollup, fw, "t-st6w"))
    assert windows.select(*keys).exceptAll(rollup.select(*keys)).count() == 0 and windows.count() == rollup.count()


def test_record_batches_leave_small_traces(spark, monkeypatch):
    """Batches of a few records have no folder each, and their log entries are written without file contexts."""
    from datetime import datetime, timedelta

    from emberwall.plans import catalog

    d, key, used = shared_dir(spark, "t-sf"), "spark.sql.streaming.checkpointFileManagerClass", set()
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 7, "view", float(i), "{}") for i in range(6400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(
        f"{d}/events.parquet")
    monkeypatch.setattr(catalog, "SIZES_STORED", 2, raising=False)
    got = catalog.QUERIES["rate_limit_records"](spark, d)
    assert sorted(map(tuple, got.collect())) == [(0, 2000), (1, 2000), (2, 2000), (3, 1040)]
    assert len(got.inputFiles()) < 4
    src = shared_dir(spark, "t-src")
    log_lines(spark, SF001).coalesce(1).write.text(src)
    writer = ST.line_stream(spark, src, max_records_per_trigger=500).writeStream
    ST._run(writer.foreachBatch(lambda b, i: used.add(b.sparkSession.conf.get(key, None))), shared_dir(spark, "t-ckpt"), None, True, True)
    assert [str(c).rsplit(".", 1)[-1] for c in used] == ["FileSystemBasedCheckpointFileManager"]
    assert spark.conf.get(key, None) is None


def test_window_state_follows_the_addresses(spark):
    """A window of few addresses holds few; counts stay within four standard errors, empty values count, nulls do not."""
    line = '{{"id":"{0}","timestamp":"2024-01-{1:02d}T{2:02d}:00:00Z","firewall_id":"f","protocol":"TCP","action":"DENY","src_ip":"10.0.0.{3}"}}'
    rows = [(line.format(i, 1 + i % 240 // 24, i % 24, i % 3),) for i in range(480)]
    src, table = shared_dir(spark, "t-src"), shared_dir(spark, "t-win")
    spark.createDataFrame(rows, "value string").write.text(src)
    q = ST.stream_window_rollup(spark, src, table, shared_dir(spark, "t-ckpt"))
    state = q.lastProgress.stateOperators[0]
    assert state.numRowsTotal == 240 and state.memoryUsedBytes < 240 * 10_000
    many = spark.range(20_000).select(
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"), *[F.lit("x").alias(c) for c in ("firewall_id", "protocol", "action")],
        F.lit(1).alias("bytes"), F.lit(1).alias("duration_ms"), F.when(F.col("id") > 0, F.col("id").cast("string")).alias("src_ip"),
        F.when(F.col("id") % 3 > 0, "").alias("dst_ip"))
    one = ST.windowed_hourly_rollup(many).first()
    assert abs(one.unique_src_ips - 19_999) < 4 * 0.01 * 19_999 and one.unique_dst_ips == 1
