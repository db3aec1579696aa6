"""Local sessions for tests and benchmarks, and reliable lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "16g") -> SparkSession:
    """A session on this machine. On a cluster, use the session the cluster gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("shelfproof")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Call sites are recorded per expression otherwise, at a round trip to the JVM each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    In local mode, where none is set, a new one that is removed when the process ends.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfproof-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same rows from Parquet files in the shared folder: compressed, and read by column."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
