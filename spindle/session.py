"""Session factory and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "spindle", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster, ``master`` is left to spark-submit and the cluster's own
    ``spark.checkpoint.dir`` is used; a scratch one is set only when unset.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          # a join whose measured partitions all fit is hashed, not sorted
          .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
          .config("spark.sql.session.timeZone", "UTC")
          # delete checkpoint files once nothing references them (long loops)
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:      # local mode: the driver JVM is the executor
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only if unset and all
    tasks run in this process. On a cluster a local folder would be lost on the
    executors, so an unset one is an error there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="spindle-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


_scope = threading.local()


@contextmanager
def scratch_removed(spark: SparkSession):
    """Tables that ``written`` makes inside are removed at the end: whatever is made of them
    must be written by then. For loops and streams, whose rounds would pile them up."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        for path in paths:
            drop_path(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back. Unlike a checkpoint, the
    files tell Spark the table's size, which decides how it is joined."""
    path = scratch_path(df.sparkSession, name)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_by(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` written below the shared folder in buckets of ``keys`` and read back: joins on
    the keys don't move it again. The table's entry is the session's own."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = os.path.basename(path).replace("-", "_")
    (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
     .option("path", path).format("parquet").saveAsTable(table))
    return spark.table(table)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate, once what was made of it is written too."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
