"""Folders that driver and executors share, for queries that write files and read them back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, deleted when the application ends; a temporary one of our own only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to a new folder, for frames that are read several times."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def tasks(df: DataFrame, rows: int) -> int:
    """How many tasks hold about ``rows`` each."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The rows dealt by keys over as many tasks as hold about ``rows`` each, so that a task's memory doesn't grow with the table."""
    df = written(df, "dealt")
    return df.repartition(tasks(df, rows), *keys)
