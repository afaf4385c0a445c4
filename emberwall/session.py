"""Session settings and shared storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC instants, adaptive execution (coalescing,
# skew splits for joins and rebalance writes), no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions": "true",
    # small writes to many folders keep all cores busy; large ones are cut by the advisory size
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str | None = None, app: str = "emberwall", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def session_token(spark: SparkSession | None = None):
    """Identity of the running application (None when it cannot be told), for per-session caches."""
    try:
        from pyspark import SparkContext

        sc = spark.sparkContext if spark is not None else SparkContext._active_spark_context
        if sc is None:
            return None
        return (sc.applicationId, id(sc._jsc), id(spark) if spark is not None else None)
    except Exception:  # noqa: BLE001 - remote sessions have no context handle
        return None


def ensure_utc(spark: SparkSession) -> None:
    """All instants are handled in UTC, as the reference does."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    for getter in (
        lambda: spark.sparkContext.getCheckpointDir(),
        lambda: spark.sparkContext.getConf().get("spark.checkpoint.dir", None),
        lambda: spark.conf.get("spark.checkpoint.dir", None),
    ):
        try:
            value = getter()
        except Exception:  # noqa: BLE001 - not every deployment exposes each getter
            value = None
        if value:
            return value
    return None


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Only a local session without one (tests) gets a private folder, which is
    registered as the checkpoint directory; on a cluster executors would each
    write to a folder of their own, so there a missing setting is an error.
    """
    root = _configured_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="emberwall-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    except Exception:  # noqa: BLE001 - no SparkContext handle: use the folder as is
        return local


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique sub-folder of the shared root for one job's files."""
    return f"{shared_root(spark)}/emberwall/{purpose}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    """A ``file:`` URI as a plain local path (for tests and local tooling)."""
    return path[len("file:"):] if path.startswith("file:") else path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(table_path(sf_dir, name))
