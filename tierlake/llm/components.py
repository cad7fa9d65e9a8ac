"""Connected components of a table of links, by smallest label and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, folder: str, most: int = 200) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp is the smallest node.

    Each round a node takes the smallest label among itself and its neighbours, then the
    label of its label, so a path of n nodes needs about log n rounds. Rounds are written
    under ``folder`` and read again; sums of a hub's neighbours are partial aggregates.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both.write.parquet(f"{folder}/links")
    both = spark.read.parquet(f"{folder}/links")
    both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("comp")).write.parquet(f"{folder}/labels-0")
    labels = spark.read.parquet(f"{folder}/labels-0")
    for i in range(1, most + 1):
        around = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        nearer = labels.join(around.withColumnRenamed("a", "node"), "node").select("node", F.least("comp", "near").alias("next"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        nearer.join(jump, "next").select("node", F.least("next", "far").alias("comp"), "was").write.parquet(f"{folder}/labels-{i}")
        labels = spark.read.parquet(f"{folder}/labels-{i}")
        if labels.where(F.col("comp") != F.col("was")).isEmpty():
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")
    raise RuntimeError(f"components did not settle in {most} rounds")
