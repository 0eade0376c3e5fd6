"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def components(edges: DataFrame, where: str, name: str) -> DataFrame:
    """edges: a, b (long). Gives node, root: the smallest node that is reachable, for every node of an edge.

    Alternates two steps until nothing changes: each node hangs its larger neighbours, then its smaller ones, under the smallest
    node it knows. Minima are summed before the shuffle and joined back, so a node with many neighbours is no single task's group.
    Each round is written to the shared folder `where`, which cuts the lineage.
    """
    spark = edges.sparkSession
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), where, f"{name}-0")
    before, k = None, 0
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before, k = state, k + 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        root = larger.groupBy("a").agg(F.min("b").alias("m"))
        step = larger.join(root, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        after = stored(step, where, f"{name}-{k}")
        dropped(spark, f"{where}/{name}-{k - 1}")
        now = after
