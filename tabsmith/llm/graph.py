"""Connected components of a link table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import attach, checkpointed


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _lowest(rows: DataFrame) -> DataFrame:
    """(a, m, rows): the smallest neighbour of each node and how many it has."""
    return checkpointed(rows.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows")))


def connected_components(links: DataFrame) -> DataFrame:
    """Links (a, b) → (node, root) for every linked node; root is the smallest node it reaches.

    Large-star and small-star steps in turn: each node's neighbours move to the smallest node it sees, until every
    node points at its root. Rounds grow with the logarithm of the longest chain; each is written to the checkpoint
    folder, so that lineage stays short. A node with very many neighbours meets a partial minimum, and its links get that
    minimum by broadcast (``attach``), so no task holds a hub's links.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = checkpointed(edges)
    before = _signature(edges)
    if not before[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        n = 2 * before[0]
        low = _lowest(both).withColumn("m", F.least("a", "m"))
        large = checkpointed(attach(both.filter("b > a"), low, "a", "rows", n).select(F.col("b").alias("a"), F.col("m").alias("b")))
        small = attach(large, _lowest(large), "a", "rows", n).select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = checkpointed(small.select("e.*").filter("a <> b").distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
