"""Work tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; others are refused, as executors would write to disks of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(first: DataFrame, name: str) -> str:
    """A new folder whose part 0 is `first`; later parts are written beside it."""
    path = new_path(first.sparkSession, name)
    first.write.parquet(f"{path}/0")
    return path


def clear_work(spark: SparkSession) -> None:
    """Delete the work tables of this application; call it when the results that read them have been used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
