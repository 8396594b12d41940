"""Tables written once to the cluster's shared folder.

A staged table cuts the lineage: what reads it no longer depends on the work
before it, and survives the loss of executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or set as the context's checkpoint
    folder."""
    folder = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {SHARED_DIR} to a folder all executors can reach")
    return folder.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder name in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged_once(df: DataFrame, label: str, partition_by: str) -> Iterator[DataFrame]:
    """Write ``df`` cut by a column and remove the copy at the end of the block."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    try:
        yield _written(df, path, partition_by)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _written(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
