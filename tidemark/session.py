"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and local timing; on a cluster use the given one."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, set up on first use.

    It is the one that the session names in ``spark.checkpoint.dir``. Where that
    is unset, a session in one JVM (a test) gets a temporary folder; on a
    cluster a folder of the driver's machine would be lost to the executors, so
    there a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the session's shared checkpoint folder and go on from it."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *by: str) -> str:
    """Write the frame as a table below the shared checkpoint folder, a folder per value of ``by``; its path."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return path


def storage(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and name of a path of Spark, for tasks that read a stored table."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return pafs.FileSystem.from_uri(path)


def written(df: DataFrame) -> DataFrame:
    """Write the frame as a table below the shared checkpoint folder and read that from then on.

    Unlike a checkpoint, the table has the size of its files for the planner;
    loops of joins over checkpoints carry sizes that multiply in every round.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stored(df))


def discard(*frames: DataFrame) -> None:
    """Delete the tables of frames that ``written`` returned; nothing may read them later."""
    for frame in frames:
        remove(frame.sparkSession, *{file.rpartition("/")[0] for file in frame.inputFiles()})


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables."""
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
