"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges: two bigint columns. Returns (id, component) for every id in a link of two different ids; the component is
    the smallest id reachable. Null ids link nothing.

    Large-star hangs every larger neighbour of a node on the node's smallest one, small-star does so with the smaller
    neighbours and the node. Both keep what is connected, and a logarithmic number of rounds leaves stars. A
    hub's neighbours are never collected: its minimum is pre-aggregated, and the join back can be split.
    Every round is a table in the shared folder, so lineage stays short.
    """
    x, y = edges.columns
    links = stored(
        edges.where(F.col(x) != F.col(y))
        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "links",
    )
    before = _print_of(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("b"))
        hung = large.join(least.withColumnRenamed("b", "m"), "a").where("b != m")
        links = stored(
            hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least).distinct(), "small-star"
        )
        now = _print_of(links)
        if now == before:
            break
        before = now
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
