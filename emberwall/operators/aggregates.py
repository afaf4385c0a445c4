"""Read-side analytics (A1-A17, W2, W3, T3-T5) over a curated log frame.

Every aggregate is a single ``agg`` (partial aggregation map-side, one
shuffle of at most one row per group per task). Exact distinct counts are
the reference's semantics; Spark plans them as Expand + two-phase aggregate,
which stays correct under a hot key because partial aggregation collapses it
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import TIMELINE_HOURS, TIMELINE_TAIL, TOP_K
from ..functions.rules import is_allowed, is_blocked
from .reshape import unpivot_endpoints


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def count_logs(logs: DataFrame) -> DataFrame:
    """A1: row count."""
    return logs.agg(F.count(F.lit(1)).alias("count"))


def overview_measures() -> list[Column]:
    """The eight overview counters as aggregate expressions."""
    sev = F.col("severity")
    return [
        F.count(F.lit(1)).alias("total_logs"),
        _count_if(is_blocked(F.col("action"))).alias("total_blocked"),
        _count_if(is_allowed(F.col("action"))).alias("total_allowed"),
        _count_if(sev == "High").alias("severity_high"),
        _count_if(sev == "Medium").alias("severity_medium"),
        _count_if(sev == "Low").alias("severity_low"),
        F.count_distinct("src_ip").alias("unique_src_ips"),
        F.count_distinct("dst_ip").alias("unique_dst_ips"),
    ]


def overview(logs: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """A2: eight counters in one pass (the reference runs eight queries).

    ``approximate=True`` swaps the two exact distinct counts for HLL++
    sketches (bounded memory, no Expand) for dashboards over very large data.
    """
    measures = overview_measures()
    if approximate:
        measures[-2] = F.approx_count_distinct("src_ip", rsd).alias("unique_src_ips")
        measures[-1] = F.approx_count_distinct("dst_ip", rsd).alias("unique_dst_ips")
    return logs.agg(*measures)


def stats_by_firewall(logs: DataFrame) -> DataFrame:
    """The overview counters per firewall."""
    return logs.groupBy("firewall_id").agg(*overview_measures())


def stats_by_protocol(logs: DataFrame) -> DataFrame:
    """A12's sibling: the overview counters per protocol."""
    return logs.groupBy("protocol").agg(*overview_measures())


def _hour_text(hour: Column) -> Column:
    # the API returns str(hour): a null hour becomes the text 'None'
    return F.coalesce(F.date_format(hour, "yyyy-MM-dd HH:mm:ss"), F.lit("None"))


def _first_hours(hourly: DataFrame, limit: int, latest: bool) -> DataFrame:
    order = F.col("_h").desc_nulls_last() if latest else F.col("_h").asc_nulls_last()
    return hourly.orderBy(order).limit(limit)


def timeline_raw(logs: DataFrame, limit: int = TIMELINE_HOURS, latest: bool = False) -> DataFrame:
    """Events per hour, ascending, first ``limit`` hours (``latest`` for the newest)."""
    hourly = logs.groupBy(F.date_trunc("hour", F.col("timestamp")).alias("_h")).agg(
        F.count(F.lit(1)).alias("total")
    )
    return _first_hours(hourly, limit, latest).select(_hour_text(F.col("_h")).alias("hour"), "total")


def timeline_split(logs: DataFrame, limit: int = TIMELINE_HOURS, latest: bool = False) -> DataFrame:
    """Hourly total, blocked and allowed."""
    hourly = logs.groupBy(F.date_trunc("hour", F.col("timestamp")).alias("_h")).agg(
        F.count(F.lit(1)).alias("total"),
        _count_if(is_blocked(F.col("action"))).alias("blocked"),
        _count_if(is_allowed(F.col("action"))).alias("allowed"),
    )
    return _first_hours(hourly, limit, latest).select(
        _hour_text(F.col("_h")).alias("hour"), "total", "blocked", "allowed"
    )


def timeline_rollup(rollup: DataFrame, logs: DataFrame | None = None, limit: int = TIMELINE_HOURS,
                    latest: bool = False) -> DataFrame:
    """A4: hourly totals from the rollup table; falls back to A3 when it is empty.

    The emptiness probe is ``isEmpty`` (reads at most one row).
    """
    if logs is not None and rollup.isEmpty():
        return timeline_raw(logs, limit, latest)
    hourly = rollup.groupBy(F.col("hour_timestamp").alias("_h")).agg(
        F.sum("total_events").cast("bigint").alias("total")
    )
    return _first_hours(hourly, limit, latest).select(_hour_text(F.col("_h")).alias("hour"), "total")


def breakdown(logs: DataFrame, column: str) -> DataFrame:
    """A5-A7 with P23: count per value, descending; null/'' shown as UNKNOWN after grouping."""
    return (
        logs.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(coalesce_unknown(F.col(column)).alias(column), "count")
        .orderBy(F.col("count").desc(), F.col(column))
    )


def coalesce_unknown(col: Column) -> Column:
    """Display label for a missing group value."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit("UNKNOWN"))


def actions(logs: DataFrame) -> DataFrame:
    return breakdown(logs, "action")


def protocols(logs: DataFrame) -> DataFrame:
    return breakdown(logs, "protocol")


def severities(logs: DataFrame) -> DataFrame:
    return breakdown(logs, "severity")


def batch_stats(classified: DataFrame) -> DataFrame:
    """Class and severity counters in one aggregate (six scans there)."""
    t, s = F.col("log_type"), F.col("severity")
    return classified.agg(
        _count_if(t == "Attack").alias("attacks"),
        _count_if(t == "Bug").alias("bugs"),
        _count_if(t == "Normal").alias("normal"),
        _count_if(s == "High").alias("high"),
        _count_if(s == "Medium").alias("medium"),
        _count_if(s == "Low").alias("low"),
    )


def class_severity(classified: DataFrame) -> DataFrame:
    """Counts per (class, severity) - the flagship summary."""
    return classified.groupBy("log_type", "severity").agg(F.count(F.lit(1)).alias("count"))


def hourly_rollup(logs: DataFrame) -> DataFrame:
    """The hourly statistics table.

    Key (hour, firewall_id, protocol, action) - all NOT NULL, so rows missing
    one are left out. ``avg_duration_ms`` ignores null durations.
    """
    keyed = logs.where(
        F.col("timestamp").isNotNull() & F.col("firewall_id").isNotNull()
        & F.col("protocol").isNotNull() & F.col("action").isNotNull()
    )
    return keyed.groupBy(
        F.date_trunc("hour", F.col("timestamp")).alias("hour_timestamp"),
        "firewall_id", "protocol", "action",
    ).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.count_distinct("src_ip").alias("unique_src_ips"),
        F.count_distinct("dst_ip").alias("unique_dst_ips"),
    )


def top_ports_build(logs: DataFrame) -> DataFrame:
    """A10: connections and last sighting per (port, source/destination, protocol)."""
    ends = unpivot_endpoints(logs).where(
        F.col("port").isNotNull() & F.col("protocol").isNotNull() & F.col("timestamp").isNotNull()
    )
    return ends.groupBy(
        "port", F.col("endpoint").alias("port_type"), "protocol"
    ).agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.max("timestamp").alias("last_seen"),
    )


DEFAULT_RISK_THRESHOLDS = (("CRITICAL", 50), ("HIGH", 40), ("MEDIUM", 30))


def risk_level(count: Column, thresholds=DEFAULT_RISK_THRESHOLDS) -> Column:
    """Risk bin from a blocked count (thresholds are ours: the reference has none)."""
    expr = None
    for label, floor in thresholds:
        cond = count >= F.lit(floor)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("LOW"))


def suspicious_ips_build(logs: DataFrame, thresholds=DEFAULT_RISK_THRESHOLDS) -> DataFrame:
    """Blocked connections and last block per (ip, source/destination), with a risk bin."""
    ends = unpivot_endpoints(logs.where(is_blocked(F.col("action")))).where(
        F.col("ip").isNotNull() & F.col("timestamp").isNotNull()
    )
    agg = ends.groupBy(F.col("ip").alias("ip_address"), F.col("endpoint").alias("ip_type")).agg(
        F.count(F.lit(1)).alias("blocked_count"),
        F.max("timestamp").alias("last_blocked"),
    )
    return agg.withColumn("risk_level", risk_level(F.col("blocked_count"), thresholds))


def top_k(df: DataFrame, measure: str, keys: list[str], k: int = TOP_K) -> DataFrame:
    """T4: the ``k`` largest by ``measure``; keys break ties so the result is stable.

    Planned as TakeOrderedAndProject: each task keeps its own top k, the
    driver merges k rows per task - never a global sort.
    """
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def top_suspicious_ips(table: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k(table, "blocked_count", ["ip_address", "ip_type"], k)


def top_ports(table: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k(table, "total_connections", ["port", "port_type", "protocol"], k)


def time_span(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """First and last instant."""
    return df.agg(F.min(column).alias("min_ts"), F.max(column).alias("max_ts"))


def share_of_total(counts: DataFrame, count_col: str = "count", digits: int = 1) -> DataFrame:
    """Each row's share of the total, percent with one decimal.

    The total is a scalar subquery (partial sums, one value back), so the
    rows are never gathered into one partition, however many groups there are.
    """
    total = counts.agg(F.sum(count_col)).scalar()
    denom = F.when(total == 0, F.lit(1)).otherwise(total)
    return counts.withColumn("pct", F.round(F.col(count_col) * 100.0 / denom, digits))


def scaled_timeline(timeline: DataFrame, tail: int = TIMELINE_TAIL) -> DataFrame:
    """W3 + T5: the last ``tail`` points, each scaled to the maximum of all points.

    The maximum is a scalar subquery over the whole timeline (not only the
    points shown), as the dashboard scales it.
    """
    mx = timeline.agg(F.max("total")).scalar()
    scaled = timeline.withColumn(
        "height_pct", F.round(F.col("total") * 100.0 / F.greatest(mx, F.lit(1)), 4)
    )
    return timeline_tail(scaled, tail)


def timeline_tail(timeline: DataFrame, tail: int = TIMELINE_TAIL) -> DataFrame:
    """T5: the last ``tail`` points of an ascending timeline, kept ascending."""
    return timeline.orderBy(F.col("hour").desc()).limit(tail).orderBy("hour")


def progress_report(progress: DataFrame, expected_total: int) -> DataFrame:
    """Percent done, rate and ETA from a progress snapshot."""
    docs = F.col("total_docs")
    rate = F.coalesce(F.col("rate_rps"), docs / F.greatest(F.col("elapsed_sec"), F.lit(1)))
    return progress.select(
        docs,
        F.lit(expected_total).alias("expected_total"),
        F.round(docs * 100.0 / F.lit(expected_total), 1).alias("pct_done"),
        F.round(rate, 1).alias("rate_rps"),
        F.round((F.lit(expected_total) - docs) / F.greatest(rate, F.lit(1)), 1).alias("eta_sec"),
    )


def reconcile_counts(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed row count against the source row count.

    Both sides are one-row aggregates combined through a union and a second
    aggregate (no join at all).
    """
    tagged = source.select(F.lit(1).alias("_s")).unionByName(landed.select(F.lit(0).alias("_s")))
    out = tagged.agg(
        F.count_if(F.col("_s") == 1).alias("source_rows"),
        F.count_if(F.col("_s") == 0).alias("landed_rows"),
    )
    return out.withColumn("matches", F.col("source_rows") == F.col("landed_rows"))
