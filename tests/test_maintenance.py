"""Compaction, merged batches, live rollups, admission by records, and column types of a CSV scan."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from emberwall.fixtures import fw_raw, log_lines
from emberwall.operators import aggregates as A
from emberwall.operators.classify import analyze_batch, to_curated
from emberwall.operators.dedup import dedup_latest
from emberwall.session import local_fs_path, shared_dir
from emberwall.sinks import batches as B, files as K, rollups as RU
from emberwall.sources import csv as CSV
from emberwall.sources.jsonl import ingest_project, ingest_rejects
from emberwall.streaming import jobs as ST
from emberwall.streaming.records import RecordReader


def same(a, b):
    return a.count() == b.count() and a.select(*b.columns).exceptAll(b).count() == 0


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(local_fs_path(path)) for f in fs if f.endswith(".parquet"))


def test_ten_replays_leave_the_merged_table_as_it_is(spark):
    table, lines = shared_dir(spark, "t-c"), log_lines(spark, SF001)
    want, rejects = dedup_latest(ingest_project(lines)), ingest_rejects(lines).distinct()
    K.dedup_append(lines, table)
    assert K.dedup_compact(spark, table) and K.dedup_compact(spark, table) == []
    size = size_of(table)
    for _ in range(10):
        K.dedup_append(lines, table)
    assert size_of(table) > 5 * size and same(K.read_latest(spark, table), want)
    K.dedup_compact(spark, table)
    assert size_of(table) < 1.2 * size and K.read_dedup_table(spark, table).count() == want.count()
    assert same(K.read_latest(spark, table), want) and same(K.read_rejects(spark, table), rejects)
    assert "SortAggregate" not in K.read_latest(spark, table)._jdf.queryExecution().executedPlan().toString()


def test_only_touched_days_are_merged_and_read_through_dedup(spark):
    table, lines = shared_dir(spark, "t-c"), log_lines(spark, SF001)
    K.dedup_append(lines, table)
    K.dedup_compact(spark, table)
    before = K.dedup_folders(spark, table)
    day = lines.where("value LIKE '%\"timestamp\":\"2024-01-03T1%Z\"%'")
    K.dedup_append(day, table)
    assert same(K.read_latest(spark, table), dedup_latest(ingest_project(lines)))
    assert same(K.read_latest(spark, table, "20240103", "20240103"),
                dedup_latest(K.read_dedup_table(spark, table, "20240103", "20240103")))
    assert K.dedup_compact(spark, table) == ["20240103"]
    after = K.dedup_folders(spark, table)
    assert {d for d in before if before[d] != after[d]} == {"20240103"}


def test_a_batch_delivered_again_keeps_its_rejects_once(spark):
    table, lines = shared_dir(spark, "t-r"), log_lines(spark, SF001)
    for _ in range(3):
        K.dedup_append(lines, table, batch_id="b-0")
    assert K.read_rejects(spark, table).count() == ingest_rejects(lines).count()
    assert K.read_dedup_table(spark, table).count() == ingest_project(lines).count()


def test_a_merge_cut_short_changes_nothing(spark):
    table, schema = shared_dir(spark, "t-b"), "k string, n bigint"
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    for batch in range(3):
        B.write_batch(spark.createDataFrame([("a", 1), ("b", batch)], schema), table, batch)

    def total():
        return {r.k: r.n for r in merge(B.read_batches(spark, table, schema)).collect()}

    assert total() == {"a": 3, "b": 3}
    # files of a merge that never committed, and one that did but has not removed what it replaces
    merge(B.read_batches(spark, table, schema)).write.parquet(f"{table}/merged=2")
    fs, mark = B.file_system(spark, f"{table}/merged=2/_SUCCESS")
    fs.delete(mark, False)
    assert total() == {"a": 3, "b": 3}
    assert B.merge_batches(spark, table, schema, merge) and total() == {"a": 3, "b": 3}
    B.write_batch(spark.createDataFrame([("a", 1), ("b", 0)], schema), table, 0)   # batch 0 delivered again after the merge
    assert total() == {"a": 3, "b": 3}
    B.write_batch(spark.createDataFrame([("a", 5)], schema), table, 3)
    assert total() == {"a": 8, "b": 3} and B.folders(spark, table) == ["batch_id=0", "batch_id=3", "merged=2"]
    assert not B.merge_batches(spark, shared_dir(spark, "t-none"), schema, merge) or True


def test_streams_merge_as_they_go(spark):
    src, fw = shared_dir(spark, "t-src"), shared_dir(spark, "t-fw")
    lines, raw = log_lines(spark, SF001), fw_raw(spark, SF001)
    lines.repartition(4).write.text(src)
    records = raw.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in raw.columns])).alias("value"))
    records.union(spark.createDataFrame([("not json",), ('{"id":"1"} tail',)], "value string")).repartition(4).write.text(fw)
    out = shared_dir(spark, "t-st7")
    ST.stream_dedup(spark, src, out, shared_dir(spark, "t-ck"), max_files_per_trigger=1, merge_every=3)
    assert B.folders(spark, out) == ["batch_id=3", "merged=2"]
    assert same(ST.read_stream_dedup(spark, out), dedup_latest(ingest_project(lines)))
    assert same(ST.read_stream_rejects(spark, out), ingest_rejects(lines).distinct())
    hours = shared_dir(spark, "t-st6")
    ST.stream_hourly_rollup(spark, fw, hours, shared_dir(spark, "t-ck"), max_files_per_trigger=1, merge_every=2)
    assert B.folders(spark, hours) == ["merged=3"]
    assert same(ST.read_hourly_rollup(spark, hours), A.hourly_rollup(to_curated(analyze_batch(raw))))
    classified = shared_dir(spark, "t-st5")
    ST.stream_classify(spark, fw, classified, shared_dir(spark, "t-ck"))
    assert ST.read_classified(spark, classified).count() == raw.count()
    assert sorted(r.raw for r in ST.read_classified_rejects(spark, classified).collect()) == ["not json", '{"id":"1"} tail']
    with pytest.raises(Exception, match="belongs to another stream"):
        ST.stream_dedup(spark, src, out, shared_dir(spark, "t-ck"))


def test_three_batches_of_live_rollups_equal_one_rebuild(spark):
    logs = to_curated(analyze_batch(fw_raw(spark, SF001))).persist()
    base = shared_dir(spark, "t-live")
    for batch in (0, 1, 2, 2):
        RU.update_rollups(logs.where(F.col("id") % 3 == batch), base, batch, merge_every=2)
    assert same(RU.read_ports(spark, base), A.top_ports_build(logs))
    assert same(RU.read_suspicious_ips(spark, base), A.suspicious_ips_build(logs))
    sums = ["hour_timestamp", "firewall_id", "protocol", "action", "total_events", "total_bytes"]
    assert same(RU.read_hours(spark, base).select(*sums), A.hourly_rollup(logs).select(*sums))
    told, exact = RU.unique_addresses(spark, base).first(), logs.where(
        "timestamp is not null and firewall_id is not null and protocol is not null and action is not null").agg(
        F.count("*"), F.count_distinct("src_ip"), F.count_distinct("dst_ip")).first()
    assert told.events == exact[0]
    assert abs(told.unique_src_ips - exact[1]) <= 0.04 * exact[1] and abs(told.unique_dst_ips - exact[2]) <= 0.04 * exact[2]


def test_records_are_admitted_exactly_and_resumed(spark):
    folder = local_fs_path(shared_dir(spark, "t-rec"))
    os.makedirs(folder)
    for name, n in (("part-2.jsonl", 700), ("part-10.jsonl", 900), ("part-1.jsonl", 3)):
        with open(f"{folder}/{name}", "w") as f:
            f.write("".join(f"{name}:{i}\n" for i in range(n)) + ("no newline" if n == 3 else ""))
    out, ck, sizes = shared_dir(spark, "t-out"), shared_dir(spark, "t-ck"), []

    def run(limit, fail_at=None):
        def each(batch, batch_id):
            if batch_id == fail_at:
                raise ValueError("stop here")
            sizes.append(batch.count())
            batch.write.mode("overwrite").text(f"{out}/b{batch_id}")

        lines = ST.line_stream(spark, folder, max_records_per_trigger=limit)
        ST._run(lines.writeStream.foreachBatch(each), ck, None, True, by_records=True)

    with pytest.raises(Exception, match="stop here"):
        run(250, fail_at=2)
    run(250)
    assert sizes == [250] * 6 + [104]
    got = [r.value for r in spark.read.option("recursiveFileLookup", True).text(out).collect()]
    assert len(got) == len(set(got)) == 1604 and "no newline" in got
    first = [v for v, in RecordReader(folder, 5).read({"file": "", "byte": 0, "records": 0})[0]]
    assert first == ["part-1.jsonl:0", "part-1.jsonl:1", "part-1.jsonl:2", "no newline", "part-2.jsonl:0"]


@pytest.mark.parametrize("path, want", [
    ("a.csv", "1"), ("{a}.csv", "1"), ("{a,b}.csv", "12"), ("a*.csv", "1"), ("?.csv", "12"), ("[bc].csv", "2"), ("", "12"),
    ("sub", "3"), ("*/c.csv", "3"), ("{a.csv,sub/c.csv}", "13")])
def test_a_scan_reads_what_it_names(spark, path, want):
    base = local_fs_path(shared_dir(spark, "t-csv"))
    os.makedirs(f"{base}/sub")
    for n, name in enumerate(("a.csv", "b.csv", "sub/c.csv"), 1):
        with open(f"{base}/{name}", "w") as f:
            f.write(f"id,x\n{n},y\n")
    assert "".join(sorted(r["id"] for r in CSV.scan_csv(spark, f"{base}/{path}").collect())) == want


def test_folders_of_one_header_are_one_scan(spark):
    base = local_fs_path(shared_dir(spark, "t-csv"))
    for n in range(5):
        os.makedirs(f"{base}/d{n}")
        with open(f"{base}/d{n}/x y.csv", "w") as f:
            f.write("id,x\n" if n < 4 else "x,id,z\n")
            f.write(f"{n},y\n" if n < 4 else f"y,{n},\n")
    out = CSV.scan_csv(spark, f"{base}/*/*.csv")
    assert sorted(r["id"] for r in out.collect()) == list("01234")
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_types_come_from_the_first_rows_and_misfits_are_told(spark):
    rows = [(str(i), f"{i}.5", "true" if i % 2 else "false", str(i), None, "007") for i in range(50)]
    rows += [("x", "1e3", "yes", "99999999999999999999", "late", "-5")] * 2
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string").coalesce(1)
    types = CSV.infer_types(df, 50)
    assert types == {"a": "bigint", "b": "double", "c": "boolean", "d": "bigint", "e": "string", "f": "bigint"}
    out = CSV.typed(df, types)
    assert dict(out.dtypes) == types and out.count() == 52 and out.where("a is null and d is null and c is null").count() == 2
    assert out.agg(F.max("b")).first()[0] == 1000.0 and out.where("e = 'late'").count() == 2
    told = {r["column"]: (r["misfits"], r["example"]) for r in CSV.misfits(df, types).collect()}
    assert told == {"a": (2, "x"), "b": (0, None), "c": (2, "yes"), "d": (2, "99999999999999999999"), "f": (0, None)}
    assert set(CSV.infer_types(df).values()) == {"string", "double", "bigint"}
