"""Connected components of links, with joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) for every node of an undirected link, the component being the
    least node that can be reached.

    Two steps alternate until nothing changes: each node's greater neighbours, then its lesser
    ones, are linked to the least node known around it. A node of any degree is a grouped
    minimum and a join, never a list. Each round is written to the shared folder.
    """
    edges = materialise(
        links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .where(F.col("lo") != F.col("hi")).distinct(), "links")
    seen = None
    while True:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi").distinct())
        near = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(near, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
            .unionByName(near.select(F.col("m").alias("lo"), "hi")).where("lo < hi").distinct()
        )
        edges = materialise(small, "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component"))
                         .distinct()))
