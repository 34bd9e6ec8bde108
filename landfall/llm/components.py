"""Connected components by alternating star joins, each round staged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node reachable.

    Large stars move the larger neighbours of a node to its smallest one, small
    stars the smaller ones; a logarithmic number of rounds leaves one star for
    each component.
    """
    links = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        links = staged(small, "links")
        after = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if after == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v"), F.col("v")).distinct()
            )
        before = after
