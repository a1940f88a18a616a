"""Connected components of a graph given as a table of links, by alternating large and small stars.

Every step is an aggregate and a join, so no component is gathered anywhere; the links after each round are written
to the shared scratch folder, which cuts the lineage and survives lost executors. The number of rounds grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbourhood."""
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the smallest of them (`u > v` in every link)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    handed = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """`node` and `root` (smallest node reachable) of every node that has a link; `links` holds columns u and v.

    Links with a null or equal ends count for nothing; repeated links are one.
    """
    spark = links.sparkSession
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        folder = scratch_folder(spark, "components")
        ordered.write.parquet(folder)
        ordered = spark.read.parquet(folder)
        state = ordered.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return ordered.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        ordered = _small_star(_large_star(ordered))
