"""Golden values at sf0.01 (FIXTURES.md section 6)."""

from pyspark.sql import functions as F

from conftest import SF01
from emberwall.fixtures import fw_raw, log_lines
from emberwall.operators import aggregates as A
from emberwall.operators.classify import analyze_api, analyze_batch, drop_corrupt
from emberwall.operators.dedup import dedup_latest, duplicate_ids
from emberwall.sources.jsonl import ingest_project, parsed_ids, with_partition_key


def counts(df, *cols):
    return {tuple(r[c] for c in cols): r["count"] for r in df.groupBy(*cols).count().collect()}


def test_class_severity_parsed_and_raw(spark):
    raw = fw_raw(spark, SF01)
    parsed = counts(analyze_batch(raw), "log_type", "severity")
    assert parsed == {("Attack", "High"): 1189, ("Attack", "Medium"): 617, ("Attack", "Low"): 559,
                      ("Bug", "High"): 189, ("Bug", "Medium"): 489, ("Bug", "Low"): 1010,
                      ("Normal", "Medium"): 3392, ("Normal", "Low"): 2555}
    rawmode = counts(analyze_batch(raw, "raw"), "log_type", "severity")
    assert rawmode[("Bug", "High")] == 516 and rawmode[("Bug", "Low")] == 683
    assert drop_corrupt(analyze_batch(raw)).count() == 10000
    assert drop_corrupt(analyze_batch(raw, "raw")).count() == 9896


def test_attack_types_and_api_profile(spark):
    raw = fw_raw(spark, SF01)
    at = counts(analyze_batch(raw).where("log_type = 'Attack'"), "attack_type")
    assert at == {("brute_force_ssh",): 416, ("sql_injection",): 217, ("ddos",): 209, ("malware_download",): 208,
                  ("port_scan",): 207, ("xss",): 206, (None,): 902}
    api = analyze_api(raw)
    assert counts(api, "log_type", "severity") == {
        ("Attack", "High"): 1278, ("Attack", "Medium"): 674, ("Attack", "Low"): 601, ("Bug", "High"): 516,
        ("Bug", "Medium"): 476, ("Normal", "Medium"): 228, ("Normal", "Low"): 6227}
    assert counts(api, "attack_type")[("other_attack",)] == 1083


def test_overview_and_breakdowns_on_raw(spark):
    raw = fw_raw(spark, SF01)
    ov = A.overview(raw.withColumn("severity", F.lit(None))).first()
    assert (ov.total_logs, ov.total_blocked, ov.total_allowed, ov.unique_src_ips, ov.unique_dst_ips) == \
        (10000, 5963, 3975, 151, 201)
    assert {r["action"]: r["count"] for r in A.actions(raw).collect()} == {
        "ACCEPT": 1988, "DROP": 1988, "REJECT": 1988, "ALLOW": 1987, "DENY": 1987, "UNKNOWN": 62}
    assert {r["protocol"]: r["count"] for r in A.protocols(raw).collect()} == {
        "ICMP": 3312, "TCP": 3312, "udp": 3312, "UNKNOWN": 64}
    tl = A.timeline_raw(raw.withColumn("timestamp", F.try_to_timestamp(
        F.regexp_replace(F.regexp_replace("timestamp", "T", " "), "Z", ""))), limit=10_000)
    assert tl.count() == 721 and tl.agg(F.sum("total")).first()[0] == 10000


def test_lines_partition_dedup_duplicates(spark):
    ln = log_lines(spark, SF01)
    parts = with_partition_key(ln).groupBy("dt", "hour").count()
    assert parts.count() == 723
    assert parts.where("dt = 'unknown' AND hour = '00'").first()["count"] == 480
    latest = dedup_latest(ingest_project(ln))
    assert latest.count() == 9441
    assert latest.where("ingest_ts > timestamp'2024-02-01 00:00:00'").count() == 944
    assert duplicate_ids(parsed_ids(ln)).count() == 979
