"""Session set-up and reliable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "chronoweave", memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks. A cluster brings its own session."""
    partitions = os.cpu_count() or 8 if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="chronoweave-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint with fixed partitions and row order."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write once to the shared folder, read many times.

    For intermediate tables with several readers: a lost executor costs no
    recomputation, each reader prunes columns (and partitions), and the planner
    sees the true size when it decides on a broadcast.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.option("compression", "zstd").parquet(path)  # texts and sort keys take less than half of what Spark's default leaves
    return spark.read.schema(df.schema).parquet(path)
