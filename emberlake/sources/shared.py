"""The folder all machines of the cluster can reach, for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only a local session may go without: it gets a
    temporary folder, which on a cluster other machines could not see."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="emberlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession) -> str:
    """A new path of its own for one scratch table or lake. What is written there belongs to the caller: a
    query's result is read from it later, so it stays until the folder of the application is cleared."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/emberlake/{app}/{uuid.uuid4().hex}"


@contextmanager
def stored_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder, so that jobs in the block neither repeat its work nor lose it
    with an executor. The files are removed at the end."""
    spark = df.sparkSession
    path = scratch_path(spark)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what was written under ``path`` and is read no more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
