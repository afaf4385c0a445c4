"""Sources and sinks: CSV of many files, landing read-back, inventory, rejects, classified CSV."""

import glob
import os

import pytest

from conftest import SF001
from emberwall.fixtures import fw_raw, log_lines
from emberwall.operators.classify import analyze_batch, drop_corrupt
from emberwall.session import local_fs_path, shared_dir
from emberwall.sinks.files import dedup_append, landing_write, read_dedup_table, read_rejects, write_classified_csv
from emberwall.sources.csv import csv_folders, scan_csv
from emberwall.sources.jsonl import landing_inventory, scan_landing


def test_csv_folders_and_union(spark):
    base = shared_dir(spark, "t-csv")
    raw = fw_raw(spark, SF001).select("id", "src_ip", "action", "flags")
    raw.where("id % 2 = 0").coalesce(2).write.option("header", True).csv(f"{base}/a")
    raw.where("id % 2 = 1").select("action", "src_ip", "id").coalesce(2).write.option("header", True).csv(f"{base}/b")
    assert [f.rsplit("/", 1)[-1] for f in csv_folders(spark, f"{base}/*/*.csv")] == ["a", "b"]
    out = scan_csv(spark, f"{base}/*/*.csv")
    assert out.count() == raw.count()
    assert out.where("id % 2 = 1 AND flags IS NOT NULL").count() == 0
    assert set(out.columns) == {"id", "src_ip", "action", "flags"}


def test_landing_keeps_hour_text(spark):
    base = shared_dir(spark, "t-land")
    landing_write(log_lines(spark, SF001), base)
    landed = scan_landing(spark, base)
    assert dict(landed.dtypes)["hour"] == "string"
    assert landed.where("hour = '00'").count() > 0
    assert landed.where("dt = 'unknown'").count() > 0
    inv = landing_inventory(spark, base).first()
    assert inv["files"] >= landed.select("dt", "hour").distinct().count() and inv["total_bytes"] > 0


def test_classified_csv_skips_empty(spark):
    path = shared_dir(spark, "t-cls")
    empty = analyze_batch(fw_raw(spark, SF001)).limit(0)
    assert write_classified_csv(empty, path) is False
    assert write_classified_csv(analyze_batch(fw_raw(spark, SF001)), path) is True


def test_dropping_corrupt_rows_leaves_the_rules_where_they_are(spark):
    """The rules run once, behind the exchange that deals out the records; not again in a filter before it."""
    kept = drop_corrupt(analyze_batch(fw_raw(spark, SF001)))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CORRUPT_LINE") <= 3
    assert "Filter" not in plan[plan.index("RepartitionByExpression"):]
    rows = spark.createDataFrame([(1, "CORRUPT_LINE|X"), (2, None), (3, ""), (3, ""), (4, "X")], "id int, bug_type string")
    assert sorted(map(tuple, drop_corrupt(rows).collect()), key=str) == [(2, None), (3, ""), (3, ""), (4, "X")]


AWKWARD = 'id,reason,action\n1,"say ""hi"", port scan",DENY\n2,"two\nlines",DROP\n3,"  padded  ",ALLOW\n4,back\\slash\\,DENY\n5,"",DENY\n'


def _file(folder, name, text):
    folder = local_fs_path(folder)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text)


def test_csv_values_are_read_and_written_as_they_are(spark):
    base = shared_dir(spark, "t-rfc")
    _file(base, "a.csv", AWKWARD)
    rows = {r["id"]: r for r in scan_csv(spark, f"{base}/*.csv").collect()}
    want = {"1": 'say "hi", port scan', "2": "two\nlines", "3": "  padded  ", "4": "back\\slash\\"}
    assert len(rows) == 5 and all(rows[k]["reason"] == v for k, v in want.items())
    assert rows["1"]["action"] == "DENY"
    out = shared_dir(spark, "t-rfc-out")
    frame = spark.createDataFrame([(k, v, "") for k, v in want.items()], "id string, reason string, bug_type string")
    assert write_classified_csv(frame, out)
    back = {r["id"]: r["reason"] for r in scan_csv(spark, out).collect()}
    assert back == want


def test_unlike_headers_in_one_folder_fail_or_take_a_manifest(spark):
    base = shared_dir(spark, "t-mixed")
    _file(base, "a.csv", "id,action\n1,DENY\n")
    _file(base, "b.csv", "action,id\nDROP,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        scan_csv(spark, f"{base}/*.csv").collect()
    groups = {"id,action": [f"{base}/a.csv"], "action,id": [f"{base}/b.csv"]}
    assert sorted((r["id"], r["action"]) for r in scan_csv(spark, base, groups).collect()) == [("1", "DENY"), ("2", "DROP")]


def test_every_line_is_stored_or_rejected_with_a_reason(spark):
    table = shared_dir(spark, "t-rej")
    lines = log_lines(spark, SF001)
    dedup_append(lines, table)
    rejects = read_rejects(spark, table)
    assert read_dedup_table(spark, table).count() + rejects.count() == lines.count()
    reasons = {r["reason"] for r in rejects.select("reason").distinct().collect()}
    assert {"bad_json", "no_timestamp", "bad_timestamp"} <= reasons
    assert rejects.where("reason = 'bad_json' AND raw LIKE '%trailing'").count() > 0
    day = read_dedup_table(spark, table, "20240103", "20240104")
    assert {str(r["d"]) for r in day.selectExpr("date(timestamp) d").distinct().collect()} == {"2024-01-03", "2024-01-04"}


@pytest.mark.parametrize("size", [100, 5000])
def test_parts_are_cut_by_bytes(spark, size):
    base = shared_dir(spark, "t-parts")
    landing_write(spark.range(400).selectExpr(f"rpad(cast(id as string), {size}, 'x') as value"), base, chunk_bytes=20 * 1024)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{local_fs_path(base)}/dt=unknown/hour=00/part-*")]
    assert sum(sizes) == 400 * (size + 1) and max(sizes) <= 21 * 1024
    assert len(sizes) <= 2 * (sum(sizes) // (20 * 1024) + 1) + 4
