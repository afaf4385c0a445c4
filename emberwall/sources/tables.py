"""Small table readers: cursor and seed timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import iso_ms_z
from ..schemas import CURATED_SCHEMA


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated firewall table (Parquet, day-partitioned)."""
    schema = T.StructType([*CURATED_SCHEMA.fields, T.StructField("created_at", T.TimestampType()),
                           T.StructField("day", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def cursor_latest(cursors: DataFrame) -> DataFrame:
    """The newest cursor per component.

    ``max(struct(updated_at, ...))`` is deterministic on ties and aggregates
    partially, so a component with millions of cursor rows still costs one
    row per task in the shuffle.
    """
    best = F.max(F.struct("updated_at", "cursor_ts", "cursor_id")).alias("b")
    return cursors.groupBy("component").agg(best).select(
        "component", F.col("b.cursor_ts").alias("cursor_ts"), F.col("b.cursor_id").alias("cursor_id")
    )


def seed_min_ts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Earliest instant as ISO-8601 ``...sssZ`` (one row; null if no rows)."""
    return df.agg(iso_ms_z(F.min(F.col(column).cast("timestamp"))).alias("seed_ts"))


def seed_min_ts_value(df: DataFrame, column: str = "timestamp") -> str:
    """S7 as a scalar; raises when there is no value, as the reference does."""
    value = seed_min_ts(df, column).first()["seed_ts"]
    if value is None:
        raise RuntimeError(f"no rows with a value in {column!r}; cannot seed initial cursor")
    return value
