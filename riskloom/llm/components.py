"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import storage


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not itself the smallest node of its component.

    Alternating large and small stars: each round ties every node to the least node it knows, through grouped minima and
    equi-joins that adaptive execution splits where a node has many links. Each round is written to shared storage, and the
    one before is deleted. An empty table gives an empty result; self-links and repeated links don't matter.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    path, before = storage.fresh_path(spark, "links"), None
    edges = storage.stored_at(edges, path)
    for _ in range(rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = now
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select("v", F.col("m").alias("u"))
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        tied = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v")
        last, path = path, storage.fresh_path(spark, "links")
        edges = storage.stored_at(tied.union(least.select("v", F.col("m").alias("u"))).distinct(), path)
        storage.removed(spark, last)
    raise RuntimeError(f"the links did not settle in {rounds} rounds")
