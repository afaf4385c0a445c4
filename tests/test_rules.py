"""Per-rule unit tests on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from emberwall.operators.classify import analyze_api, analyze_batch, bug_flags, drop_corrupt
from emberwall.schemas import RAW_SCHEMA

COLS = [f.name for f in RAW_SCHEMA.fields]


def row(**kw):
    base = dict(
        id="1", timestamp="2024-01-01T10:00:00Z", firewall_id="fw-1", src_ip="10.0.0.1", dst_ip="10.0.0.2",
        src_port="1234", dst_port="443", protocol="TCP", action="ALLOW", bytes="100", duration_ms="5",
        rule_id="R1", session_id="abcdefABCDEF", user_name="u", reason="policy match", status="ok", flags=None,
    )
    base.update(kw)
    return tuple(base[c] for c in COLS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def one(df, *cols):
    r = df.collect()[0]
    return tuple(r[c] for c in cols)


def test_clean_row_is_normal_low(spark):
    out = analyze_batch(frame(spark, row()))
    assert one(out, "log_type", "severity", "bug_type", "attack_type", "timestamp") == (
        "Normal", "Low", "", None, "2024-01-01 10:00:00")


def test_blocked_normal_is_medium(spark):
    out = analyze_batch(frame(spark, row(action="deny")))
    assert one(out, "log_type", "severity", "action") == ("Normal", "Medium", "DENY")


def test_reference_test_row_api_profile(spark):
    r = row(timestamp="2026-02-11T12:00:00", src_ip="192.168.1.10", dst_ip="10.0.0.5", reason="SSH Brute Force",
            action="DROP", protocol="TCP", dst_port="22", src_port=None, firewall_id=None, rule_id=None)
    out = analyze_api(frame(spark, r))
    assert one(out, "log_type", "bug_type", "attack_type", "severity") == ("Attack", None, "brute_force_ssh", "High")


def test_reference_test_row_batch_profile(spark):
    r = row(timestamp="2026-02-11T12:00:00", src_ip="192.168.1.10", dst_ip="10.0.0.5", reason="SSH Brute Force",
            action="DROP", protocol="TCP", dst_port="22", src_port=None, firewall_id=None, rule_id=None,
            session_id=None, bytes=None, duration_ms=None, user_name=None, status=None)
    out = analyze_batch(frame(spark, r))
    assert one(out, "log_type", "bug_type", "attack_type", "severity") == (
        "Bug", "MISSING_SRC_PORT|MISSING_TIMESTAMP|MISSING_FIREWALL_ID|MISSING_RULE_ID", None, "Medium")


@pytest.mark.parametrize("kw,label", [
    (dict(src_ip="999x999y999z999"), "INVALID_IP_SRC"),          # dots are regex wildcards
    (dict(dst_ip="999.999.999.999"), "INVALID_IP_DST"),
    (dict(bytes="-5"), "NEGATIVE_BYTES"),
    (dict(src_port="abc"), "NONNUMERIC_PORT_SRC"),
    (dict(dst_port="70000"), "NONNUMERIC_PORT_DST"),
    (dict(src_port=None), "MISSING_SRC_PORT"),
    (dict(protocol=None), "MISSING_PROTOCOL"),
    (dict(action=""), "MISSING_ACTION"),
    (dict(reason=None), "MISSING_REASON"),
    (dict(firewall_id=""), "MISSING_FIREWALL_ID"),
    (dict(session_id="abcdefABCDE\n"), "INVALID_SESSION_ID"),    # no match before a final newline
    (dict(session_id="short"), "INVALID_SESSION_ID"),
    (dict(rule_id=None), "MISSING_RULE_ID"),
    (dict(timestamp="2024-01-01 10:00:00"), "MISSING_TIMESTAMP"),  # strict format: no T/Z -> null
])
def test_single_label(spark, kw, label):
    out = analyze_batch(frame(spark, row(**kw)))
    assert one(out, "bug_type", "log_type") == (label, "Bug")


def test_raw_mode_time_labels_and_corrupt_filter(spark):
    rows = [row(id="1", timestamp="CORRUPTED_LINE x"), row(id="2", timestamp="2024-13-01T00:00:00Z"), row(id="3")]
    parsed = analyze_batch(frame(spark, *rows), "parsed")
    raw = analyze_batch(frame(spark, *rows), "raw")
    assert sorted(r["bug_type"] for r in parsed.collect()) == ["", "MISSING_TIMESTAMP", "MISSING_TIMESTAMP"]
    got = {r["id"]: (r["bug_type"], r["severity"]) for r in raw.collect()}
    assert got["1"] == ("CORRUPT_LINE", "High")
    assert got["2"] == ("MALFORMED_TIMESTAMP", "High")
    assert [r["id"] for r in drop_corrupt(raw).collect()] == ["2", "3"] or \
        sorted(r["id"] for r in drop_corrupt(raw).collect()) == ["2", "3"]


def test_attack_detection_three_valued(spark):
    rows = [row(id="1", reason=None, flags=None), row(id="2", reason="x", flags="auth_fail"),
            row(id="3", reason="Port Scan detected", flags=None)]
    out = {r["id"]: r for r in analyze_batch(frame(spark, *rows)).collect()}
    assert out["1"]["log_type"] == "Bug"           # missing reason is a label
    assert (out["2"]["log_type"], out["2"]["severity"], out["2"]["attack_type"]) == ("Attack", "High", None)
    assert (out["3"]["log_type"], out["3"]["severity"], out["3"]["attack_type"]) == ("Attack", "Medium", "port_scan")


def test_attack_type_order(spark):
    rows = [row(id="1", reason="suspicious sql payload and malware"), row(id="2", reason="Potential DDoS"),
            row(id="3", reason="Ransomware")]
    out = {r["id"]: r["attack_type"] for r in analyze_batch(frame(spark, *rows)).collect()}
    assert out == {"1": "sql_injection", "2": "ddos", "3": None}
    api = {r["id"]: r["attack_type"] for r in analyze_api(frame(spark, *rows)).collect()}
    assert api == {"1": "sql_injection", "2": "ddos", "3": "other_attack"}


def test_api_normal_needs_suspicious_and_blocked(spark):
    rows = [row(id="1", reason="No policy", action="drop"), row(id="2", reason="policy match", action="DROP")]
    out = {r["id"]: r["severity"] for r in analyze_api(frame(spark, *rows)).collect()}
    assert out == {"1": "Medium", "2": "Low"}


def test_bug_flags_columns(spark):
    out = bug_flags(frame(spark, row(src_port="abc")))
    assert one(out, "nonnumeric_port_src", "missing_src_port") == ("NONNUMERIC_PORT_SRC", None)


def test_no_python_udfs_in_plan(spark):
    out = analyze_batch(frame(spark, row()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_relative_time(spark):
    from emberwall.functions.timefmt import relative_time
    df = spark.createDataFrame([("2024-01-15 00:00:00",), ("2024-01-14 23:59:30",), ("2024-01-14 23:15:00",),
                                ("2024-01-14 02:00:00",), ("2024-01-10 00:00:00",), (None,)], "t string")
    out = df.select(relative_time(F.to_timestamp("t"), F.to_timestamp(F.lit("2024-01-15 00:00:00"))).alias("a"))
    assert [r["a"] for r in out.collect()] == ["Just now", "Just now", "45m ago", "22h ago", "2024-01-10", "—"]


def test_parse_iso_lenient_and_strict(spark):
    from emberwall.functions.timefmt import parse_iso
    df = spark.createDataFrame([("2024-01-05T10:00:00+02:00",), ("2024-01-05T10:00:00Z",), ("bad",), (None,)], "t string")
    got = [r["p"] for r in df.select(F.date_format(parse_iso(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("p")).collect()]
    assert got == ["2024-01-05 08:00:00", "2024-01-05 10:00:00", None, None]
    good = df.where("t <> 'bad'").select(parse_iso(F.col("t"), strict=True).alias("p"))
    assert good.where("p IS NOT NULL").count() == 2
    with pytest.raises(Exception):
        df.select(parse_iso(F.col("t"), strict=True).alias("p")).collect()
