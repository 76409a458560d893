"""Shared pieces: reading inputs, work tables in the shared folder, bounded samples."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid

import numpy as np
import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest number of 8-byte keys that is ever broadcast; above it a shuffle join is used.
BROADCAST_KEYS = 4_000_000
#: Rows of an Arrow batch, where the session has Spark's default of 10,000: texts are long, and batches lie beside the heap.
BATCH_ROWS = "1000"
#: Rows that meet in one step of a sum over tasks.
FAN = 64

# Python workers live on from task to task: with the system's allocator what a task freed goes back at once.
pyarrow.set_memory_pool(pyarrow.system_memory_pool())
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system, also that of earlier tasks of this process, where the C library can do so."""
    if _trim is not None:
        _trim(0)


#: What a process keeps from task to task; tasks of other kinds empty it.
caches: list[dict] = []


def trimmed(run):
    """run(batches) for tasks that keep nothing: what others kept goes before, and what it freed goes back to the system after."""

    def whole(batches):
        for kept in caches:
            kept.clear()
        yield from run(batches)
        give_back()

    return whole


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; others are refused,
    as executors would write to disks of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete the work tables of this application; call it when the results that read them have been used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of df has, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder_of_id(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def held_out(modulus: int, remainder: int) -> Column:
    """True where crc32(doc_id as text) mod `modulus` is `remainder`; a null id counts as not held out."""
    return F.coalesce(remainder_of_id(modulus) == remainder, F.lit(False)).alias("held_out")


def keep_keys(df: DataFrame, keys: DataFrame, on: str, n_keys: int) -> DataFrame:
    """Rows of df whose `on` is among the distinct `keys` (n_keys of them): broadcast while small, else shuffled."""
    return df.join(F.broadcast(keys) if n_keys <= BROADCAST_KEYS else keys.hint("shuffle_hash"), on, "left_semi")


def sampled_texts(docs: DataFrame, ids: DataFrame, *on: str) -> DataFrame:
    """The rows of ids(doc_id, ...), a bounded sample, each with one text of that id: of rows that share an id (and the columns `on`), the one with the smallest hash."""
    rows = docs.select("doc_id", *on, "text").join(F.broadcast(ids), ["doc_id", *on])
    return rows.groupBy(*ids.columns).agg(F.min_by(F.struct("text"), F.xxhash64("text")).alias("t")).select(*ids.columns, "t.text")


def _summed(rows):
    import pandas as pd

    total = sum(np.frombuffer(x, np.float64) for x in rows["sums"])
    return pd.DataFrame({"axis": [rows["axis"].iloc[0]], "part": [rows["part"].iloc[0]], "sums": [total.tobytes()]})


def tree_sum(rows: DataFrame) -> dict[int, np.ndarray]:
    """Sums over all tasks of rows (axis, sums: bytes of doubles), a few of fixed size from each task: FAN tasks' rows meet at a time, level by level."""
    rows = written(rows.withColumn("part", F.spark_partition_id()), "sums")
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = -(-parts // FAN)
        level = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("axis", "part").applyInPandas(_summed, "axis int, part int, sums binary")
        rows = written(level, "sums") if parts > 1 else level
    return {r["axis"]: np.frombuffer(r["sums"], np.float64) for r in rows.collect()}
