"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.repeats import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every linked node and the smallest node it reaches.

    Each round hooks every node and its neighbours to the smallest of them, first
    the larger neighbours, then the smaller ones, until nothing changes. Rounds
    grow as the logarithm of the longest chain. A hub is no hot group: minima are
    combined before the shuffle, and its links are rows of their own. Lineage is
    cut by a stored table in each round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stored(edges.filter("u <> v").distinct(), "links")
    mark = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(large.distinct(), "links")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u <> v").unionAll(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
