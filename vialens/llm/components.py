"""Connected components of links, by alternating stars, all in joins and aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialens.llm.shared import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; the root is the least node reached.

    Every round hangs each node's larger neighbours on its least one, then its
    smaller ones; the links end as stars after about log(n) rounds, each one
    written table. No round brings the links of a node together in one row.
    """
    edges = settle(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u != v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        edges = settle(small.filter("u != v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
