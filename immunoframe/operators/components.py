"""Connected components of an edge list, over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import drop_staged, staged


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (its smallest node) of every node that has an edge to another.

    Large-star and small-star contraction; each step is an aggregate summed before the shuffle and an equality join.
    Edges with a null end and loops are passed over; no edges give no rows. Every step's table replaces the one before.
    """
    own = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        before, own = own, staged(small.distinct(), "edges")
        drop_staged(before)
        now = own.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    roots = own.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
