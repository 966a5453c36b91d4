"""Session helpers: a local session for tests/bench and the shared work folder.

Jobs never build their own session. Scratch output (intermediate tables,
stream checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) a private
folder is created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the jobs are designed for."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; registers a private one only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    # Unset. A machine-local folder is only acceptable when everything runs in
    # this one process (local mode, tests); on a cluster executors could not
    # reach it, so the shared folder must be configured.
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
    local = tempfile.mkdtemp(prefix="reelhouse-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root for one job run's scratch tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/work/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, resolved through the cluster's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: without one it means the cluster's default file system, as anywhere in Hadoop."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a job's own staging folder once its last reader has finished."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
