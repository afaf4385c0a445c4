"""DuckDB phrasing of the fixtures and rules, used as the correctness oracle.

The oracle is written independently of the DataFrame code: CASE chains and
``contains`` in SQL, only the fixed phrase lists are shared.
"""

from __future__ import annotations

import re

from ..fixtures import duckdb_cte
from ..functions import constants as K


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_contains(col: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(p)})" for p in phrases) + ")"


def regex_any(col: str, phrases, flags: str = "") -> str:
    alt = "|".join(re.escape(p) for p in phrases)
    return f"regexp_matches({col}, {q(alt)}{', ' + q(flags) if flags else ''})"


def in_list(col: str, values) -> str:
    return f"{col} IN ({', '.join(q(v) for v in values)})"


TS = "'%Y-%m-%d %H:%M:%S'"
TS_MS = "'%Y-%m-%d %H:%M:%S.%g'"


def fmt_ts(expr: str) -> str:
    return f"strftime({expr}, {TS})"


FW_COLS = ("id, timestamp, firewall_id, src_ip, dst_ip, src_port, dst_port, protocol, action, bytes, "
           "duration_ms, rule_id, session_id, user_name, reason, status, flags")


def fw_raw_cte() -> str:
    return f"fw_raw AS ({duckdb_cte('fw_raw')})"


def log_lines_cte() -> str:
    return f"log_lines AS ({duckdb_cte('log_lines')})"


def batch_labels(ts_rule: str) -> list[tuple[str, str]]:
    """(label, SQL condition) in emission order, batch profile."""
    return [
        ("CORRUPT_LINE", f"starts_with({ts_rule}, 'CORRUPTED_LINE')"),
        ("MALFORMED_TIMESTAMP", any_contains(ts_rule, K.MALFORMED_TIMESTAMP_MARKS)),
        ("INVALID_IP_SRC", "regexp_matches(src_ip, '999.999.999.999')"),
        ("INVALID_IP_DST", "regexp_matches(dst_ip, '999.999.999.999')"),
        ("NEGATIVE_BYTES", "try_cast(CAST(bytes AS VARCHAR) AS DOUBLE) < 0"),
        ("NONNUMERIC_PORT_SRC", "(regexp_matches(src_port, '[^0-9]') OR try_cast(src_port AS DOUBLE) > 65535)"),
        ("NONNUMERIC_PORT_DST", "(regexp_matches(dst_port, '[^0-9]') OR try_cast(dst_port AS DOUBLE) > 65535)"),
        ("MISSING_SRC_PORT", "src_port IS NULL"),
        ("MISSING_DST_PORT", "dst_port IS NULL"),
        ("MISSING_SRC_IP", "src_ip IS NULL"),
        ("MISSING_DST_IP", "dst_ip IS NULL"),
        ("MISSING_TIMESTAMP", f"{ts_rule} IS NULL"),
        ("MISSING_PROTOCOL", "protocol IS NULL"),
        ("MISSING_ACTION", "(action IS NULL OR action = '')"),
        ("MISSING_REASON", "(reason IS NULL OR reason = '')"),
        ("MISSING_FIREWALL_ID", "(firewall_id IS NULL OR firewall_id = '')"),
        ("INVALID_SESSION_ID", "(session_id IS NOT NULL AND NOT regexp_full_match(session_id, '[a-zA-Z0-9]{12}'))"),
        ("MISSING_RULE_ID", "rule_id IS NULL"),
    ]


def label_case(label: str, cond: str) -> str:
    return f"CASE WHEN {cond} THEN {q(label)} END"


def joined(labels: list[tuple[str, str]]) -> str:
    return "NULLIF(concat_ws('|', " + ", ".join(label_case(n, c) for n, c in labels) + "), '')"


def attack_test(reason: str, flags: str) -> str:
    return (f"({regex_any(reason, K.ATTACK_REASON_PATTERNS, 'i')} OR "
            f"{regex_any(flags, K.ATTACK_FLAG_PATTERNS, 'i')})")


def attack_family(reason_lower: str, fallback: str) -> str:
    whens = " ".join(
        f"WHEN {any_contains(reason_lower, phrases)} THEN {q(name)}" for name, phrases in K.ATTACK_TYPE_RULES
    )
    return f"CASE {whens} ELSE {fallback} END"


def classified_ctes(mode: str = "parsed", source: str = "fw_raw") -> str:
    """CTE chain ending in ``classified`` (the batch classifier's output)."""
    ts_rule = "ts_norm" if mode == "parsed" else "CAST(timestamp AS VARCHAR)"
    high = f"({any_contains('reason', K.HIGH_SEVERITY_PHRASES)} OR {any_contains('flags', K.HIGH_SEVERITY_FLAGS)})"
    medium = f"({any_contains('reason', K.MEDIUM_SEVERITY_PHRASES)} OR {any_contains('flags', K.MEDIUM_SEVERITY_FLAGS)})"
    return f"""
b1 AS (
  SELECT *, strftime(try_strptime(CAST(timestamp AS VARCHAR), '%Y-%m-%dT%H:%M:%SZ'), {TS}) AS ts_norm FROM {source}
),
b2 AS (
  SELECT *, {joined(batch_labels(ts_rule))} AS bug_type, {attack_test('reason', 'flags')} AS is_attack FROM b1
),
b3 AS (
  SELECT id, ts_norm AS timestamp, firewall_id, src_ip, dst_ip, src_port, dst_port,
         upper(coalesce(protocol, '')) AS protocol, upper(coalesce(action, '')) AS action, bytes, duration_ms,
         rule_id, session_id, user_name, lower(coalesce(reason, '')) AS reason, status,
         upper(coalesce(flags, '')) AS flags, coalesce(bug_type, '') AS bug_type,
         CASE WHEN bug_type IS NOT NULL THEN 'Bug' WHEN is_attack THEN 'Attack' ELSE 'Normal' END AS log_type
  FROM b2
),
classified AS (
  SELECT *,
    CASE WHEN log_type = 'Attack' THEN
           CASE WHEN {high} THEN 'High' WHEN {medium} THEN 'Medium' ELSE 'Low' END
         WHEN log_type = 'Bug' THEN
           CASE WHEN {any_contains('bug_type', K.HIGH_BUG_MARKERS)} THEN 'High'
                WHEN {any_contains('bug_type', K.MEDIUM_BUG_MARKERS)} THEN 'Medium'
                WHEN {any_contains('bug_type', K.LOW_BUG_MARKERS)} THEN 'Low'
                ELSE 'Medium' END
         ELSE CASE WHEN {in_list('action', K.BLOCKED_ACTIONS)} THEN 'Medium' ELSE 'Low' END
    END AS severity,
    CASE WHEN log_type = 'Attack' THEN {attack_family('reason', 'NULL')} END AS attack_type
  FROM b3
)"""


def api_ctes(source: str = "fw_raw") -> str:
    """CTE chain ending in ``api`` (the API-profile analyser)."""
    labels = [
        ("CORRUPT_LINE", "contains(ts_s, 'CORRUPTED_LINE')"),
        ("MALFORMED_TIMESTAMP", any_contains("ts_s", K.MALFORMED_TIMESTAMP_MARKS)),
        ("INVALID_IP_SRC", "contains(src_s, '999.999.999.999')"),
        ("INVALID_IP_DST", "contains(dst_s, '999.999.999.999')"),
        ("MISSING_SRC_IP", "src_s = ''"),
        ("MISSING_DST_IP", "dst_s = ''"),
        ("MISSING_TIMESTAMP", "ts_s = ''"),
        ("MISSING_PROTOCOL", "coalesce(protocol, '') = ''"),
        ("MISSING_ACTION", "coalesce(action, '') = ''"),
        ("MISSING_REASON", "coalesce(reason, '') = ''"),
    ]
    high = f"({any_contains('r_l', K.HIGH_SEVERITY_PHRASES)} OR {any_contains('f_u', K.HIGH_SEVERITY_FLAGS)})"
    medium = f"({any_contains('r_l', K.MEDIUM_SEVERITY_PHRASES)} OR {any_contains('f_u', K.MEDIUM_SEVERITY_FLAGS)})"
    return f"""
a1 AS (
  SELECT *, coalesce(CAST(timestamp AS VARCHAR), '') AS ts_s, coalesce(src_ip, '') AS src_s,
         coalesce(dst_ip, '') AS dst_s, lower(coalesce(reason, '')) AS r_l, upper(coalesce(flags, '')) AS f_u,
         upper(coalesce(action, '')) AS a_u
  FROM {source}
),
a2 AS (
  SELECT *, {joined(labels)} AS bug_type,
         {attack_test("coalesce(reason, '')", "coalesce(flags, '')")} AS is_attack
  FROM a1
),
a3 AS (
  SELECT *, CASE WHEN bug_type IS NOT NULL THEN 'Bug' WHEN is_attack THEN 'Attack' ELSE 'Normal' END AS log_type
  FROM a2
),
api AS (
  SELECT {FW_COLS}, log_type, bug_type,
    CASE WHEN is_attack THEN {attack_family('r_l', "'other_attack'")} END AS attack_type,
    CASE WHEN log_type = 'Attack' THEN
           CASE WHEN {high} THEN 'High' WHEN {medium} THEN 'Medium' ELSE 'Low' END
         WHEN log_type = 'Bug' THEN
           CASE WHEN {any_contains('bug_type', K.API_HIGH_BUG_MARKERS)} THEN 'High' ELSE 'Medium' END
         ELSE CASE WHEN {any_contains('r_l', K.SUSPICIOUS_NORMAL_PHRASES)} AND {in_list('a_u', K.BLOCKED_ACTIONS)}
                   THEN 'Medium' ELSE 'Low' END
    END AS severity
  FROM a3
)"""


CURATED_CTE = """
curated AS (
  SELECT CAST(id AS BIGINT) AS id, try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, firewall_id,
         src_ip, dst_ip, try_cast(src_port AS INTEGER) AS src_port, try_cast(dst_port AS INTEGER) AS dst_port,
         protocol, action, try_cast(bytes AS BIGINT) AS bytes, try_cast(duration_ms AS INTEGER) AS duration_ms,
         rule_id, session_id, user_name, reason, status, flags, bug_type, log_type AS log_category, severity,
         attack_type
  FROM classified
)"""


def with_classified(mode: str = "parsed") -> str:
    return f"WITH {fw_raw_cte()}, {classified_ctes(mode)}"


def with_curated() -> str:
    return f"WITH {fw_raw_cte()}, {classified_ctes('parsed')}, {CURATED_CTE}"


def with_api() -> str:
    return f"WITH {fw_raw_cte()}, {api_ctes()}"


# ---- JSON lines -------------------------------------------------------------

def line_time(value: str = "value") -> str:
    """P4 event time in UTC (TIMESTAMP) for a JSON line; null when unusable."""
    ts = (f"CASE WHEN json_valid({value}) THEN coalesce(nullif(json_extract_string({value}, '$.timestamp'), ''), "
          f"nullif(json_extract_string({value}, '$.\"@timestamp\"'), '')) END")
    return iso_utc(ts)


def iso_utc(text: str) -> str:
    return (f"CASE WHEN regexp_matches({text}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
            f"THEN (try_cast({text} AS TIMESTAMPTZ) AT TIME ZONE 'UTC') END")


LINES_PARSED_CTE = """
lp AS (
  SELECT value AS raw, json_valid(value) AS ok,
         CASE WHEN json_valid(value) THEN json_extract_string(value, '$.id') END AS id,
         CASE WHEN json_valid(value) THEN json_extract_string(value, '$.timestamp') END AS ts_s,
         CASE WHEN json_valid(value) THEN json_extract_string(value, '$.ingest_ts') END AS its_s
  FROM log_lines
),
ingested AS (
  SELECT id, date_trunc('millisecond', {ts}) AS timestamp, date_trunc('millisecond', {its}) AS ingest_ts, raw
  FROM lp
  WHERE ok AND ts_s IS NOT NULL AND {ts} IS NOT NULL AND id IS NOT NULL AND {its} IS NOT NULL
)""".format(ts=iso_utc("ts_s"), its=iso_utc("its_s"))


def with_ingested() -> str:
    return f"WITH {log_lines_cte()}, {LINES_PARSED_CTE}"


LATEST_CTE = """
latest AS (
  SELECT id, timestamp, ingest_ts, raw FROM (
    SELECT *, row_number() OVER (PARTITION BY timestamp, id ORDER BY ingest_ts DESC, raw DESC) AS rn
    FROM ingested) WHERE rn = 1
)"""
