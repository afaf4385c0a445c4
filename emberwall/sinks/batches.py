"""Tables of one folder per micro-batch, with merged generations.

``batch_id=N`` holds what batch N wrote and is replaced if the batch runs
again. ``merged=N`` holds what all batches up to N come to; it counts once its
job has committed, and then takes the place of every older folder, so a reader
never sees a batch twice, whatever moment it comes in or a merge was cut short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BATCH, MERGED = "batch_id=", "merged="
#: A stream merges its batches whenever so many have come since the last merge.
MERGE_EVERY = 64


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API, for names and sizes of files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``: one listing."""
    fs, place = file_system(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def stream_id(spark: SparkSession) -> str | None:
    """Id of the streaming query whose batch is at hand; it stays with the query's checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def claim(spark: SparkSession, table: str) -> None:
    """A table's batches are numbered by one checkpoint; another stream's numbers would take the place of its batches."""
    owner = stream_id(spark)
    if owner is None:
        return
    fs, mark = file_system(spark, f"{table}/_stream")
    if fs.exists(mark):
        file = fs.open(mark)
        known = file.readUTF()
        file.close()
        if known != owner:
            raise RuntimeError(f"{table} belongs to another stream; go on from its checkpoint or write to another table")
        return
    file = fs.create(mark, False)
    file.writeUTF(owner)
    file.close()


def write_batch(df: DataFrame, table: str, batch_id: int) -> None:
    """What batch ``batch_id`` comes to; a batch that is delivered again replaces its own folder."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{table}/{BATCH}{int(batch_id)}")


def live_folders(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """(last merged batch or -1, folders that count): the newest committed merge and the batches after it."""
    names = folders(spark, table)
    fs, place = file_system(spark, table)
    child = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    merged = [int(n[len(MERGED):]) for n in names if n.startswith(MERGED)
              and fs.exists(child(place, f"{n}/_SUCCESS"))]
    last = max(merged, default=-1)
    batches = sorted(int(n[len(BATCH):]) for n in names if n.startswith(BATCH))
    return last, [f"{MERGED}{last}"] * (last >= 0) + [f"{BATCH}{b}" for b in batches if b > last]


def read_batches(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows that count; none if nothing has been written."""
    _, live = live_folders(spark, table)
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table}/{name}" for name in live])


def merge_batches(spark: SparkSession, table: str, schema: str, merge: Callable[[DataFrame], DataFrame]) -> bool:
    """Write what the live folders come to as a new generation, then remove what it takes the place of.

    Run it where batches are written (a stream does so between two of its
    batches). Cut short before its commit it changes nothing; after that only
    folders that no longer count are left. Returns whether there was anything to merge.
    """
    last, live = live_folders(spark, table)
    newest = max([last, *(int(n[len(BATCH):]) for n in live if n.startswith(BATCH))])
    if newest > last:
        merge(read_batches(spark, table, schema)).write.mode("overwrite").option("compression", "zstd").parquet(
            f"{table}/{MERGED}{newest}")
    for name in folders(spark, table):
        kind, _, number = name.partition("=")
        if f"{kind}=" in (BATCH, MERGED) and int(number) <= newest and name != f"{MERGED}{newest}":
            remove(spark, f"{table}/{name}")
    return newest > last


def write_and_merge(df: DataFrame, table: str, batch_id: int, schema: str, merge: Callable[[DataFrame], DataFrame],
                    every: int = MERGE_EVERY) -> None:
    """One micro-batch; every so many, what has come so far is merged."""
    claim(df.sparkSession, table)
    write_batch(df, table, batch_id)
    if every and batch_id % every == every - 1:
        merge_batches(df.sparkSession, table, schema, merge)
