"""JSON-lines ingestion: scan, projection, partition key, landing read-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import first_present, parse_iso, partition_dt, partition_hour

LANDING_SCHEMA = "value string, dt string, hour string"
_INGEST_FIELDS = "id string, timestamp string, ingest_ts string"
_TIME_FIELDS = "timestamp string, `@timestamp` string"
_END = "__end_of_line__"


def parsed_once(lines: DataFrame, value: str, fields: str) -> DataFrame:
    """``lines`` with ``j``: the line's JSON fields as text, null where the line is not strict JSON.

    The line is parsed as a member of an object that ends with a mark of its
    own, so text after the line's JSON, which the parser would pass over,
    makes the whole unreadable. Generating the parsed row (of one element)
    keeps later filters and columns from parsing the line again.
    """
    whole = F.concat(F.lit('{"v":'), F.col(value), F.lit(f',"{_END}":1}}'))
    schema = f"v struct<{fields.replace(' string', ': string')}>, {_END} int, _corrupt string"
    j = F.from_json(whole, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt",
                                    "allowSingleQuotes": "false"})
    return lines.select("*", F.explode(F.array(j)).alias("__p")).select(
        "*", F.when(F.col("__p._corrupt").isNull() & (F.col(f"__p.{_END}") == 1), F.col("__p.v")).alias("j")).drop("__p")


def scan_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """S3 (batch twin): one string ``value`` per line of every file under ``path``."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def with_partition_key(lines: DataFrame, value: str = "value") -> DataFrame:
    """``dt``/``hour`` of each line in UTC from its first non-empty of ``timestamp`` / ``@timestamp``;

    unusable (not strict JSON, no time or a bad one) -> ``unknown``/``00``.
    """
    timed = parsed_once(lines, value, _TIME_FIELDS).withColumn(
        "__t", parse_iso(first_present(F.col("j.timestamp"), F.col("j.`@timestamp`"))))
    return timed.withColumns({"dt": partition_dt(F.col("__t")), "hour": partition_hour(F.col("__t"))}).drop("j", "__t")


def _parsed(lines: DataFrame, value: str) -> DataFrame:
    return parsed_once(lines.select(F.col(value).alias("raw")), "raw", _INGEST_FIELDS).select(
        "raw", F.col("j.id").alias("id"), F.col("j.timestamp").alias("_ts"), F.col("j.ingest_ts").alias("_its"),
        F.col("j").isNull().alias("_bad_json"),
    ).withColumns({
        "timestamp": F.date_trunc("millisecond", parse_iso(F.col("_ts"))),
        "ingest_ts": F.date_trunc("millisecond", parse_iso(F.col("_its"))),
    })


def _reject_reason() -> Column:
    return (
        F.when(F.col("_bad_json"), F.lit("bad_json"))
        .when(F.col("_ts").isNull(), F.lit("no_timestamp"))
        .when(F.col("timestamp").isNull(), F.lit("bad_timestamp"))
        .when(F.col("id").isNull(), F.lit("missing_id"))
        .when(F.col("ingest_ts").isNull(), F.lit("bad_ingest_ts"))
    )


def ingest_marked(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(id, timestamp, ingest_ts, raw, reason)`` of every line, parsed once; ``reason`` is null where it is usable,
    and else says why not and nothing but ``raw`` is kept."""
    reason = _reject_reason()
    usable = lambda c: F.when(F.col("reason").isNull(), F.col(c)).alias(c)
    return _parsed(lines, value).withColumn("reason", reason).select(
        *[usable(c) for c in ("id", "timestamp", "ingest_ts")], "raw", "reason")


def ingest_project(lines: DataFrame, value: str = "value") -> DataFrame:
    """P5: ``(id, timestamp, ingest_ts, raw)`` for every usable line.

    The reference drops a line without ``timestamp`` and stops the job on
    bad JSON or a bad time; here such lines go to ``ingest_rejects`` instead.
    """
    return (
        _parsed(lines, value)
        .where(_reject_reason().isNull())
        .select("id", "timestamp", "ingest_ts", "raw")
    )


def ingest_rejects(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines ``ingest_project`` leaves out, with the reason."""
    reason = _reject_reason()
    return _parsed(lines, value).where(reason.isNotNull()).select(reason.alias("reason"), "raw")


def parsed_ids(lines: DataFrame, value: str = "value") -> DataFrame:
    """``id`` of every line that parses as JSON (for id audits)."""
    return _parsed(lines, value).where(~F.col("_bad_json")).select("id", "raw")


def scan_landing(spark: SparkSession, base: str) -> DataFrame:
    """The landing zone with ``dt``/``hour`` kept as text (``hour=00`` stays ``00``).

    Giving the schema fixes the partition column types, so no type inference
    is needed; filters on ``dt``/``hour`` prune whole folders.
    """
    return spark.read.schema(LANDING_SCHEMA).option("basePath", base).text(base).select("value", "dt", "hour")


def landing_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Number of files and total bytes under the landing zone.

    Only ``path`` and ``length`` are selected, so file contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    return files.select("path", "length").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )


def landing_latest_parts(spark: SparkSession, base: str, n: int = 8) -> DataFrame:
    """The ``n`` last part paths in name order, with their sizes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    return files.select("path", "length").orderBy(F.col("path").desc()).limit(n)
