"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidylake.llm.common import settled


def _largest_first(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``): the smallest
    node reachable.

    Alternates two steps until nothing changes: every node's larger neighbours
    are linked to its smallest neighbour, then its smaller neighbours are.  Each
    step is a grouped minimum and an equi-join, so a node with very many links is
    never gathered in one place; a few rounds turn any component into a star.
    """
    edges = settled(_largest_first(links))
    last = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                           F.col("m").alias("b"))
        kept = edges.join(least, "a").select("a", F.col("m").alias("b"))
        edges = _largest_first(large.union(kept))
        smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(smallest, "a")
        edges = settled(_largest_first(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                smallest.select("a", F.col("m").alias("b")))))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b"), F.col("b"))).distinct()
