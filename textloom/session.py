"""Session and scratch-space helpers.

Scratch space (lineage cuts, staged tables, fixture files) always lives under
the shared checkpoint directory named by the cluster in ``spark.checkpoint.dir``.
Only a local master without that setting (tests) gets a folder of its own; on a cluster
executors' own /tmp folders would not hold each other's files, so there it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "textloom", extra: dict | None = None, driver_memory: str = "8g") -> SparkSession:
    """Session for tests, bench and the CLI; ``master=None`` leaves it to spark-submit."""
    builder = SparkSession.builder if master is None else SparkSession.builder.master(master)
    builder = (
        builder
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoint files of iterative jobs (BPE rounds) are removed once their RDDs are collected.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    scratch_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package, wherever the driver was started.

    A cluster gets it with ``--py-files``; a path that isn't there does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory; set a local one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused directory path under the shared scratch space."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/stages/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as a Parquet stage in the shared scratch space and read it back.

    Cuts lineage (executor loss recomputes from the stage) and lets multi-pass steps
    scan a column store instead of recomputing upstream work.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_stage(df) -> None:
    """Delete the folder of a ``materialize``d stage that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
