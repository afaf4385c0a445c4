"""ST7 with keyed state: equal to W1 however files are batched, restarts, redelivery, time to live."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from emberwall.fixtures import log_lines
from emberwall.operators.dedup import dedup_latest
from emberwall.session import shared_dir
from emberwall.sinks.batches import read_batches
from emberwall.sources.jsonl import ingest_project, ingest_rejects
from emberwall.streaming import keyed as K


def same(a, b):
    a, b = (sorted(map(str, x.collect())) for x in (a, b.select(*a.columns)))
    return a == b


def check(spark, table, lines, times=1):
    usable, bad = ingest_project(lines), ingest_rejects(lines)
    want = dedup_latest(usable)
    assert same(want, K.read_stream_latest(spark, table))
    assert same(bad.distinct(), K.read_latest_rejects(spark, table))
    n, keys = usable.count() * times, want.count()
    assert tuple(K.read_latest_counts(spark, table).first()) == (n, keys, n - keys, bad.count() * times)


def written(spark, table):
    return read_batches(spark, table, K._CHANGE).where("raw IS NOT NULL").count()


@pytest.mark.parametrize("files,merge_every", [(4, None), (2, None), (1, 2)])
def test_equal_to_w1_for_any_batches(spark, files, merge_every):
    src, table = shared_dir(spark, "t-src"), shared_dir(spark, "t-keyed")
    before = {c: spark.conf.get(c) for c in K._SETTINGS}
    lines = log_lines(spark, SF001)
    lines.repartition(4).write.text(src)
    K.stream_latest(spark, src, table, shared_dir(spark, "t-ckpt"), max_files_per_trigger=files, merge_every=merge_every)
    assert {c: spark.conf.get(c) for c in K._SETTINGS} == before
    check(spark, table, lines)


def test_redelivery_after_a_restart_writes_counts_only(spark):
    src, table, ckpt = (shared_dir(spark, x) for x in ("t-src", "t-keyed", "t-ckpt"))
    lines = log_lines(spark, SF001)
    lines.repartition(2).write.text(f"{src}/a")
    K.stream_latest(spark, src, table, ckpt)
    first = written(spark, table)
    lines.repartition(3).write.text(f"{src}/b")
    K.stream_latest(spark, src, table, ckpt)
    assert written(spark, table) == first
    check(spark, table, lines, times=2)


def test_state_that_has_gone_changes_no_result(spark):
    src, table, ckpt = (shared_dir(spark, x) for x in ("t-src", "t-keyed", "t-ckpt"))
    lines = log_lines(spark, SF001).limit(200)
    lines.coalesce(1).write.text(f"{src}/a")
    K.stream_latest(spark, src, table, ckpt, ttl_ms=1)
    first = written(spark, table)
    lines.coalesce(1).write.text(f"{src}/b")
    K.stream_latest(spark, src, table, ckpt, ttl_ms=1)
    assert written(spark, table) == 2 * first
    check(spark, table, lines, times=2)


def test_one_key_with_most_lines_and_ties(spark):
    src, table = shared_dir(spark, "t-src"), shared_dir(spark, "t-keyed")
    line = '{{"id":"{}","timestamp":"2024-01-01T00:00:00Z","ingest_ts":"2024-02-01T00:00:{:02d}Z","n":{}}}'
    rows = [(line.format("hot", i % 3, i),) for i in range(3000)] + [(line.format(f"k{i}", 0, 0),) for i in range(20)]
    lines = spark.createDataFrame([*rows, ("",), ("x",), ("x",)], "value string")
    lines.repartition(3).write.text(src)
    K.stream_latest(spark, src, table, shared_dir(spark, "t-ckpt"), max_files_per_trigger=1)
    check(spark, table, lines)


def test_collapsing_leaves_a_row_for_each_key(spark):
    import pyarrow as pa

    names = [*K._KEYS, "ingest_us", "raw"]
    kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.string()]
    rows = [(1, "a", None, None, 5, "x"), (1, "a", None, None, 5, "y"), (1, "a", None, None, 4, "z"), (None, None, "bad_json", "d", None, "q")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
    out = next(K.collapsed(iter([batch]))).to_pylist()
    assert [(r["id"], r["ingest_us"], r["raw"], r["seen"]) for r in out] == [("a", 5, "y", 3), (None, None, "q", 1)]


def test_no_batches_yet(spark):
    table = shared_dir(spark, "t-keyed")
    assert K.read_stream_latest(spark, table).count() == 0
    assert tuple(K.read_latest_counts(spark, table).first()) == (0, 0, 0, 0)


def test_without_a_time_to_live_no_key_calls_python(spark):
    """The running aggregate holds the keys; lines seen are told in total, versions by the batch that brings them."""
    src, table, ckpt = (shared_dir(spark, x) for x in ("t-src", "t-keyed", "t-ckpt"))
    line = '{{"id":"{}","timestamp":"2024-01-01T00:00:00Z","ingest_ts":"2024-02-01T00:00:{:02d}Z"}}'
    for i, rows in enumerate(([("a", 1), ("a", 2), ("b", 1)], [("a", 1), ("b", 3)], [("a", 2), ("b", 1)])):
        spark.createDataFrame([(line.format(*r),) for r in rows], "value string").coalesce(1).write.text(f"{src}/{i}")
        q = K.stream_latest(spark, src, table, ckpt)
        assert q.lastProgress.stateOperators[0].operatorName == "stateStoreSave"
    got = [(r.id, r.raw is not None, r.total) for r in read_batches(spark, table, K._CHANGE).collect()]
    assert sorted(got) == [("a", False, 3), ("a", False, 4), ("a", True, 2), ("b", False, 3), ("b", True, 1), ("b", True, 2)]
    assert tuple(K.read_latest_counts(spark, table).first()) == (7, 2, 5, 0)
    assert {r.id: str(r.ingest_ts)[-1] for r in K.read_stream_latest(spark, table).collect()} == {"a": "2", "b": "3"}
