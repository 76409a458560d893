"""Connected components of an edge table, distributed: smallest neighbour's label, then labels of labels, until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (id, label): for each id in an edge the smallest id it can reach. Each round is written to the shared folder."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("id"), "label", F.lit(True).alias("changed")), "labels")
    while labels.where("changed").limit(1).count():
        old = labels.drop("changed")
        near = both.join(old.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        new = old.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = old.select(F.col("id").alias("label"), F.col("label").alias("up"))
        new = new.join(up, "label", "left").withColumn("label", F.coalesce("up", "label"))
        labels = written(new.select("id", "label", (F.col("label") != F.col("old")).alias("changed")), "labels")
    return labels.drop("changed")
