"""SparkSession construction and the shared work folder.

Intermediate tables (checkpoints between outlier passes, sinks written by
queries) go to the folder named by ``spark.checkpoint.dir``.  On a cluster
that setting points at shared storage and is read from the session; only when
it is unset (local tests) do we create a private folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "ecoframe", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on, UI off, UTC clock and Arrow enabled."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint folder); sets
    a private one only where none is configured, as in local tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="ecoframe-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the work folder for one written table."""
    base = work_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str):
    """Write to the shared work folder and read back: cuts the lineage (and
    the logical plan), and survives executor loss (unlike a local
    checkpoint)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Removes the files of a table that `materialize` wrote and nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
