"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from emberwall.session import shared_dir

#: A word is a run of anything but ASCII white space (Java syntax; possessive, as nothing follows).
WORD_RUN = r"[^\x20\x09-\x0D]++"


#: Idle Python workers stay, so what a task frees goes back to the system: large blocks at once, others when they
#: add up, and Arrow's like all else.
_WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "262144", "MALLOC_ARENA_MAX": "2",
                  "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and give freed memory back.

    The first serves local sessions and clusters that share the folder, whatever
    the working directory; elsewhere the package comes with ``--py-files``.
    Settings that the environment has already are left as they are.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for name, value in _WORKER_MEMORY.items():
        env.setdefault(name, os.environ.get(name, value))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder that goes when the application ends.

    Unlike a checkpoint, a table is planned by its real size; the estimates a
    checkpoint hands on multiply with every join of an iteration until they
    take all of the driver's memory.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    path = shared_dir(spark, "scratch")
    df.write.parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else left as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine) -> Column:
    """Running sums (or the like, for an associative ``combine`` of two columns) of an array, in n log n steps.

    Every step combines each value with the one 1, 2, 4, ... places before.
    """
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))
    return F.aggregate(rounds, values, lambda done, k: F.transform(done, lambda x, i: F.coalesce(
        combine(x, F.get(done, i - F.call_function("shiftleft", F.lit(1), k))), x)))


def match_spans(text: Column, pattern: str | Column) -> Column:
    """Leftmost non-overlapping matches as (start, end, value, before), in code points and in time near-linear in them.

    What lies between the matches adds up to where they begin; ``before`` is that part with the match before it.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    both = F.struct(F.regexp_extract_all(text, regex, F.lit(0)).alias("v"), F.split(text, regex, -1).alias("b"))

    def placed(p):
        lengths = F.transform(p["v"], lambda v, i: F.length(v) + F.length(F.get(p["b"], i)))
        return let(running(lengths, lambda x, y: x + y), lambda ends: F.transform(p["v"], lambda v, i: F.struct(
            (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"),
            F.concat(F.coalesce(F.get(p["v"], i - 1), F.lit("")), F.get(p["b"], i)).alias("before"))))

    return let(both, placed)


#: A side of a join is broadcast only when it has been counted and has at most so many narrow rows.
BROADCAST_ROWS = 50_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` (already computed, narrow) marked for broadcast if it is counted small, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def numbered(df: DataFrame, *order: Column, into: str = "place") -> DataFrame:
    """``df`` with 0, 1, 2, ... in the given order, sorted and counted without gathering the rows in one task."""
    at = cut_lineage(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    # one row per sorted partition, so this window sees as many rows as there are partitions
    before = (at.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
              .withColumn("__before", F.sum("__rows").over(Window.orderBy("__part")) - F.col("__rows")))
    return (at.withColumn("__part", part).join(before, "__part")
            .withColumn(into, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__at", "__part", "__rows", "__before"))
