"""A training-data pipeline over `documents`: quality, near duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next stage's docs.

Defined results: null texts count as empty; rows with a null doc_id can't be linked or matched and pass the stages that drop documents; rows that repeat a
doc_id go or stay together in these; an empty table passes every stage as an empty table; columns beyond those of documents, whatever their names, are
kept up to the last stage, which returns what the files hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import decontam, jaccard, mixing, quality, tokenids
from factloom.llm.common import BROADCAST_KEYS, documents, new_path, table, unused, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, accepts."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: that with the smallest id."""
    found = jaccard.near_duplicates(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return _without(docs, gone)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    gone = decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _without(docs, gone)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix in ORC files; what the files hold of each document."""
    path = new_path(spark, "token-ids")
    tokenids.write(docs, path)
    return tokenids.digests(spark, path)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is not in gone; rows with a null doc_id stay."""
    (key,) = unused(docs, "gone")
    gone = written(gone.select(F.col("doc_id").alias(key)), "gone")
    keys = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
    return docs.join(keys, F.col("doc_id") == F.col(key), "left_anti")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: Trained trees, latent search and balanced sampling can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
