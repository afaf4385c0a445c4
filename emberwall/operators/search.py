"""Filters, text search and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import DASHBOARD_PAGE_SIZE, PAGE_SIZE, PREVIEW_COLUMNS, PREVIEW_ROWS

SEARCH_COLUMNS = ("src_ip", "dst_ip", "reason", "firewall_id")


def filter_equals(logs: DataFrame, severity: str | None = None, action: str | None = None,
                  protocol: str | None = None) -> DataFrame:
    """P20: optional case-sensitive equality filters; None or '' means no filter.

    Plain column predicates, so they reach the Parquet scan as pushed filters.
    """
    for name, value in (("severity", severity), ("action", action), ("protocol", protocol)):
        if value:
            logs = logs.where(F.col(name) == F.lit(value))
    return logs


def search_logs(logs: DataFrame, text: str | None) -> DataFrame:
    """Case-insensitive substring over four columns, OR-ed.

    ``%`` and ``_`` in ``text`` stay wildcards, as in the reference's ILIKE.
    """
    if not text:
        return logs
    pattern = f"%{text}%"
    cond = None
    for c in SEARCH_COLUMNS:
        term = F.col(c).ilike(pattern)
        cond = term if cond is None else (cond | term)
    return logs.where(cond)


def page_logs(logs: DataFrame, skip: int = 0, limit: int = PAGE_SIZE, severity: str | None = None,
              action: str | None = None, protocol: str | None = None, search: str | None = None) -> DataFrame:
    """Filtered, newest first (nulls first, as PostgreSQL sorts), then offset/limit.

    ``id`` breaks timestamp ties so pages are stable. Offset + limit plan as
    a bounded top-k (skip + limit rows per task), not a full sort.
    """
    filtered = search_logs(filter_equals(logs, severity, action, protocol), search)
    ordered = filtered.orderBy(F.col("timestamp").desc_nulls_first(), F.col("id").asc())
    if skip:
        ordered = ordered.offset(skip)
    return ordered.limit(limit)


def dashboard_page(logs: DataFrame, page: int = 0, size: int = DASHBOARD_PAGE_SIZE, **filters) -> DataFrame:
    """The dashboard's page ``page`` of ``size`` rows."""
    return page_logs(logs, skip=page * size, limit=size, **filters)


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """Seven columns, first ``n`` rows, no order."""
    return df.select(*[c for c in PREVIEW_COLUMNS if c in df.columns]).limit(n)


def chronological_export(df: DataFrame, num_partitions: int | None = None,
                         ts: str = "timestamp", key: str = "id") -> DataFrame:
    """Rows in time order within and across output partitions.

    Range partitioning samples the key to pick split points, so a hot time
    range is split by ``key`` rather than landing in one task.
    """
    n = num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartitionByRange(int(n), F.col(ts).asc_nulls_last(), F.col(key)).sortWithinPartitions(
        F.col(ts).asc_nulls_last(), F.col(key)
    )
