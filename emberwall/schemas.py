"""Schemas: curated firewall table, raw variant, rollup tables, cursor."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(), "BOOLEAN": T.BooleanType(),
}


def _struct(spec: str) -> T.StructType:
    """Flat ``name TYPE, ...`` spec to a StructType (no session needed at import)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ.upper()]))
    return T.StructType(fields)


# Curated table (21 columns, without the wall-clock created_at here).
CURATED_DDL = (
    "id BIGINT, timestamp TIMESTAMP, firewall_id STRING, src_ip STRING, dst_ip STRING, "
    "src_port INT, dst_port INT, protocol STRING, action STRING, bytes BIGINT, duration_ms INT, "
    "rule_id STRING, session_id STRING, user_name STRING, reason STRING, status STRING, "
    "flags STRING, bug_type STRING, log_category STRING, severity STRING, attack_type STRING"
)
CURATED_SCHEMA = _struct(CURATED_DDL)

# Raw records: everything as text so malformed values reach the rules.
RAW_DDL = (
    "id STRING, timestamp STRING, firewall_id STRING, src_ip STRING, dst_ip STRING, "
    "src_port STRING, dst_port STRING, protocol STRING, action STRING, bytes STRING, "
    "duration_ms STRING, rule_id STRING, session_id STRING, user_name STRING, reason STRING, "
    "status STRING, flags STRING"
)
RAW_SCHEMA = _struct(RAW_DDL)

HOURLY_ROLLUP_SCHEMA = _struct(
    "hour_timestamp TIMESTAMP, firewall_id STRING, protocol STRING, action STRING, "
    "total_events BIGINT, total_bytes BIGINT, avg_duration_ms DOUBLE, unique_src_ips BIGINT, "
    "unique_dst_ips BIGINT"
)
TOP_PORTS_SCHEMA = _struct(
    "port INT, port_type STRING, protocol STRING, total_connections BIGINT, last_seen TIMESTAMP"
)
SUSPICIOUS_IPS_SCHEMA = _struct(
    "ip_address STRING, ip_type STRING, blocked_count BIGINT, last_blocked TIMESTAMP, risk_level STRING"
)
DEDUP_RAW_SCHEMA = _struct("id STRING, timestamp TIMESTAMP, ingest_ts TIMESTAMP, raw STRING")
CURSOR_SCHEMA = _struct("component STRING, cursor_ts STRING, cursor_id STRING, updated_at TIMESTAMP")
PROGRESS_SCHEMA = _struct(
    "total_docs BIGINT, parts_written BIGINT, elapsed_sec DOUBLE, rate_rps DOUBLE, updated_at STRING"
)
