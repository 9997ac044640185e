"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomledger.llm.common import settle


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """id, component: for each id in the links (columns a, b) the least id that it reaches.

    Each round links the larger neighbours of a node to its least neighbour (large star),
    then the smaller ones (small star), until every edge leads to the least id of its
    component.  Rounds grow with the logarithm of the longest path; a round shuffles the
    edges only, least neighbours are partial aggregates, so a hub is never gathered.
    """
    edges = settle(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct())
        previous, state = state, _state(edges)
        if state == previous:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
