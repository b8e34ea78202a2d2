"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator relies on: UTC wall clock for NTZ arithmetic, AQE for
# runtime re-planning (partition coalescing, skew splits, SMJ -> BHJ when a side
# turns out small), and footer-only MIN/MAX/COUNT for `as_of` resolution.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for a large cluster (thousands of executors, ~100 TB):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, 256 MB
# scan splits, and skew splitting of hot join partitions.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sensorflow", extra: dict | None = None) -> SparkSession:
    """Return the active session (or build one) with the settings above applied.

    On a cluster the master and resources come from spark-submit; ``master``
    is only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if spark.conf.isModifiable(k):  # core settings of a running session stay as they are
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins; only a local run (tests) may do without and gets
    a temporary folder. On a cluster that would be each machine's own disk, so
    an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a table written to the shared folder and read back.

    Used for small computed tables read more than once (per-sensor statistics,
    reduced correlation input); recomputation after an executor loss then starts
    from the files, not from the source scan. The plan knows the files' size, so
    the broadcast check sees what was written, not an estimate from the source.
    """
    path = scratch_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root.

    Used for written intermediate tables and round-trip outputs; never a
    machine-local temp folder, so it survives executor loss on a cluster.
    """
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sensorflow/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tooling (DuckDB, os) can open a path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local_fs(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


__all__ = ["CLUSTER_CONF", "get_session", "checkpoint_root", "materialize", "scratch_dir", "local_path", "is_local_fs",
           "SESSION_CONF"]
