"""Derived inputs over the driver's ``events`` table (see FIXTURES.md).

The SQL below is written once and used twice: by Spark (``spark.sql`` with a
DataFrame argument, so no global view names are involved) and as a CTE in the
DuckDB oracle. Braces are doubled because the text is a ``str.format`` template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import ensure_utc, read_table

FW_RAW_TEMPLATE = """
SELECT
  event_id AS id,
  CASE WHEN event_id % 97 = 0 THEN 'CORRUPTED_LINE ' || CAST(event_id AS STRING)
       WHEN event_id % 89 = 0 THEN '2024-13-01T00:00:00Z'
       WHEN event_id % 83 = 0 THEN '2024-01-01T99:99:99Z'
       WHEN event_id % 79 = 0 THEN NULL
       ELSE replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || 'Z' END AS timestamp,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'fw-' || CAST(user_id % 5 AS STRING) END AS firewall_id,
  CASE WHEN event_id % 103 = 0 THEN '999.999.999.999' WHEN event_id % 107 = 0 THEN NULL
       ELSE '10.0.' || CAST(user_id % 16 AS STRING) || '.' || CAST(user_id AS STRING) END AS src_ip,
  CASE WHEN event_id % 109 = 0 THEN '999.999.999.999' WHEN event_id % 113 = 0 THEN NULL
       ELSE '192.168.' || CAST((event_id * 3) % 8 AS STRING) || '.' || CAST((event_id * 7) % 200 AS STRING) END AS dst_ip,
  CASE WHEN event_id % 127 = 0 THEN 'abc' WHEN event_id % 131 = 0 THEN '70000' WHEN event_id % 137 = 0 THEN NULL
       ELSE CAST(1024 + (event_id * 37) % 60000 AS STRING) END AS src_port,
  CASE WHEN event_id % 139 = 0 THEN 'http' WHEN event_id % 149 = 0 THEN '99999' WHEN event_id % 151 = 0 THEN NULL
       WHEN event_id % 4 = 0 THEN '443' WHEN event_id % 4 = 1 THEN '80' WHEN event_id % 4 = 2 THEN '22' ELSE '53' END AS dst_port,
  CASE WHEN event_id % 157 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'TCP' WHEN event_id % 3 = 1 THEN 'udp' ELSE 'ICMP' END AS protocol,
  CASE WHEN event_id % 163 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'DENY' WHEN event_id % 5 = 1 THEN 'DROP'
       WHEN event_id % 5 = 2 THEN 'REJECT' WHEN event_id % 5 = 3 THEN 'ALLOW' ELSE 'ACCEPT' END AS action,
  CASE WHEN event_id % 167 = 0 THEN -1 ELSE CAST(floor(value * 100) AS BIGINT) END AS bytes,
  CAST((event_id * 13) % 5000 AS BIGINT) AS duration_ms,
  CASE WHEN event_id % 173 = 0 THEN NULL ELSE 'R' || CAST(event_id % 50 AS STRING) END AS rule_id,
  CASE WHEN event_id % 179 = 0 THEN 'bad-session' ELSE lpad(CAST(event_id AS STRING), 12, 'a') END AS session_id,
  CASE WHEN event_id % 2 = 0 THEN 'user' || CAST(user_id AS STRING) ELSE NULL END AS user_name,
  CASE WHEN event_id % 181 = 0 THEN NULL
       WHEN (event_id * 7) % 40 = 0 THEN 'SQL injection' WHEN (event_id * 7) % 40 = 1 THEN 'SSH Brute Force'
       WHEN (event_id * 7) % 40 = 2 THEN 'Known malicious domain' WHEN (event_id * 7) % 40 = 3 THEN 'Potential DDoS'
       WHEN (event_id * 7) % 40 = 4 THEN 'port scan' WHEN (event_id * 7) % 40 = 5 THEN 'XSS attempt'
       WHEN (event_id * 7) % 40 = 6 THEN 'Ransomware' WHEN (event_id * 7) % 40 = 7 THEN 'Path traversal'
       WHEN (event_id * 7) % 40 = 8 THEN 'Suspicious payload' WHEN (event_id * 7) % 40 = 9 THEN 'No policy'
       WHEN (event_id * 7) % 40 = 10 THEN 'Multiple auth failures'
       WHEN event_id % 191 = 0 THEN 'say ' || chr(34) || 'hi' || chr(34) || ', policy match'
       WHEN event_id % 193 = 0 THEN '  padded  ' WHEN event_id % 197 = 0 THEN 'back' || chr(92) || 'slash ' || chr(92)
       WHEN event_id % 199 = 0 THEN 'two' || chr(10) || 'lines'
       ELSE 'policy match' END AS reason,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN (event_id * 11) % 60 = 0 THEN 'scan' WHEN (event_id * 11) % 60 = 1 THEN 'AUTH_FAIL'
       WHEN (event_id * 11) % 60 = 2 THEN 'EXPLOIT' WHEN (event_id * 11) % 60 = 3 THEN 'XSS' ELSE NULL END AS flags
FROM {events}
"""

LOG_LINES_TEMPLATE = """
WITH e AS (
  SELECT event_id, ts, 0 AS delay FROM {events}
  UNION ALL
  SELECT event_id, ts, 60 AS delay FROM {events} WHERE event_id % 10 = 0
)
SELECT CASE WHEN event_id % 97 = 0 THEN 'not json ' || CAST(event_id AS STRING)
  WHEN event_id % 191 = 0 THEN '{{' || chr(39) || 'id' || chr(39) || ':' || chr(39) || 'e' || CAST(event_id AS STRING) || chr(39)
    || ',' || chr(39) || 'timestamp' || chr(39) || ':' || chr(39) || '2024-01-01T00:00:00Z' || chr(39) || '}}'
  WHEN event_id % 193 = 0 THEN '{{"id":"e' || CAST(event_id AS STRING) || '","timestamp":"2024-01-01T00:00:00Z","ingest_ts":"2024-02-01T00:00:00Z"}} trailing'
  ELSE '{{"id":"e' || CAST(event_id AS STRING) || '"' ||
    CASE WHEN event_id % 89 = 0 THEN '' WHEN event_id % 83 = 0 THEN ',"timestamp":"bad"'
         WHEN event_id % 79 = 0 THEN ',"@timestamp":"' || replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || 'Z"'
         WHEN event_id % 7 = 0 THEN ',"timestamp":"' || replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '+02:00"'
         ELSE ',"timestamp":"' || replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || 'Z"' END ||
    ',"ingest_ts":"' || CASE WHEN delay = 0 THEN '2024-02-01T00:00:00.000Z' ELSE '2024-02-01T00:01:00.000Z' END || '"}}' END AS value
FROM e
"""

FW_COLUMNS = (
    "id", "timestamp", "firewall_id", "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
    "action", "bytes", "duration_ms", "rule_id", "session_id", "user_name", "reason", "status", "flags",
)


def _derived(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """The derived frame; records are dealt over as many tasks as shuffles have, as files from many sources would be."""
    ensure_utc(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.sql(template, events=read_table(spark, sf_dir, "events").repartition(tasks, "event_id"))


def fw_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firewall records derived from ``events`` (one per event, every rule exercised)."""
    return _derived(spark, sf_dir, FW_RAW_TEMPLATE)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSONL lines derived from ``events`` (``value`` column), with re-sent versions."""
    return _derived(spark, sf_dir, LOG_LINES_TEMPLATE)


def cursor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor-table rows from ``events``: two components, ``updated_at = ts``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("event_id") % 2 == 0, F.lit("stream")).otherwise(F.lit("backfill")).alias("component"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("cursor_ts"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("cursor_id"),
        F.col("ts").cast("timestamp").alias("updated_at"),
    )


def duckdb_cte(name: str) -> str:
    """The fixture as DuckDB SQL over the pre-registered ``events`` view."""
    template = {"fw_raw": FW_RAW_TEMPLATE, "log_lines": LOG_LINES_TEMPLATE}[name]
    return template.format(events="events")
