"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.llm.tables import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link; the component is its smallest node.

    Alternates two steps: every node hands its larger neighbours to its smallest neighbour, then its smaller ones. Links
    shrink to stars around the smallest node; their number never grows. A node's neighbours are never gathered: its minimum is combined
    before the shuffle and joined back. Every step is written once, and what it changed is counted as it is written: links
    that neither step changes are stars.
    """
    edges, _ = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    handed = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(
            F.col("v").alias("to"), F.col("m"), (F.col("m") != F.col("u")).cast("int").alias("moved")
        ).groupBy("to", "m").agg(F.max("moved").alias("moved")).select(F.col("to").alias("u"), F.col("m").alias("v"), "moved")
        large, seen = written(large, "links", moved=F.sum("moved"))
        if handed == 0 and not seen["moved"]:
            break
        large = large.select("u", "v")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        parts = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(1).alias("handed")).unionByName(
            lowest.select("u", F.col("m").alias("v"), F.lit(0).alias("handed"))
        )
        edges, seen = written(parts.groupBy("u", "v").agg(F.max("handed").alias("handed")), "links", handed=F.sum("handed"))
        edges, handed = edges.select("u", "v"), seen["handed"] or 0
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
