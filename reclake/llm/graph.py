"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Rounds of two steps: nodes hand their smallest neighbour to larger neighbours, then to smaller ones and themselves, until
    every node points at the smallest of its component. Each round is one table; minima are taken before the shuffle and no
    node's neighbours are gathered. Rounds grow with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = materialize(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "lowest")
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.filter("a <> b").distinct(), "links")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
