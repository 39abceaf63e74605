"""Session construction and shared-storage helpers.

Library code never invents storage locations on its own: scratch output
(stream checkpoints, stage tables) lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is unset (local tests, the
bench) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours gets.  AQE re-plans joins and coalesces small
# shuffle partitions at runtime; skew-join splits oversized join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "inkwell",
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests and the bench.  On a cluster, build your own session
    and leave ``spark.checkpoint.dir`` pointing at shared storage."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  Only a single-process session may
    leave it unset; it gets a local one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="inkwell-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for a frame that
    several branches of a plan use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_of(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as it wants it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
