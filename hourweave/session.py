"""Session helpers: building a local session and cutting lineage safely."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of one task of a sort or window.  Missing and filled values compress so well that a partition of the usual bytes
#: holds millions of panel rows, whose sort then takes gigabytes.
TASK_ROWS = 1 << 18
#: Rows of one written file of panel rows; a reading task takes some 30 small files.
FILE_ROWS = 1 << 16


def build_session(master: str | None = None, partitions: int = 8, app: str = "hourweave") -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HOURWEAVE_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always honoured (read from
    the session, then from the SparkContext).  Only when it is unset and the master is
    local (tests) a scratch folder is created and registered with ``setCheckpointDir``
    (the conf itself is not modified, as a running session may reject that); on a
    cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not (sc.master == "local" or sc.master.startswith("local[")):
        # a driver-local folder is invisible to executors: never fall back to one on a cluster
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="hourweave-ckpt-"))
    return sc.getCheckpointDir()


def task_count(df: DataFrame, copies: float = 1.0) -> int:
    """Tasks for the rows of ``df`` times ``copies``, TASK_ROWS each; 0 if one task will do.

    The rows are counted, which for a written table reads the footers of its files.
    """
    rows = df.count() * copies
    return max(math.ceil(rows / TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism) if rows > TASK_ROWS else 0


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` over so many tasks; with 0 it is left to Spark, which goes by bytes."""
    return df.repartition(tasks, *keys) if tasks else df


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, file_rows: int | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written table, not from
    the raw input) and lets later stages prune columns and push filters into the
    scan.  Each call writes a new path, so a path being read is never overwritten.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.parquet(path)
    return spark.read.parquet(path)
