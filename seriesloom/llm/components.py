"""Connected components of a link table, in DataFrame rounds that end when nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storing import stored as staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node with a link to another one.

    Two alternating steps turn the links into stars around the smallest node: first every node's larger
    neighbours are linked to its smallest one, then its smaller ones. Both are grouped minima, combined before
    the shuffle, and joins on the node, whose large partitions Spark can split. Each round is written to the
    shared folder. Loops, repeated links, both directions and null ends are allowed and change nothing.
    """
    kind = links.schema[a].dataType
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("v") != F.col("u"))
    )
    edges, before = staged(edges.distinct()), None
    while True:
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).union(edges.select("u", "v"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").where(F.col("y") > F.col("x")).select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.where(F.col("v") != F.col("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(
            F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")
        )
        edges = staged(small.select("e.*").where(F.col("v") != F.col("u")).distinct())
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    centres = edges.select(F.col("u").alias("node")).distinct()
    found = edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        centres.select("node", F.col("node").alias("component"))
    )
    return found.select(F.col("node").cast(kind), F.col("component").cast(kind))
