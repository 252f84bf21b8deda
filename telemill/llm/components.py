"""Connected components of a table of links, by alternating large and small stars.

Every round replaces links by links to smaller nodes and keeps components as they
are, until each component is a star around its smallest node. Rounds grow with the
logarithm of a component's size. Neighbourhoods are reduced by ``min`` before they
are joined back, so a node with very many links never gathers them in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release


def _star(both: DataFrame, keep) -> DataFrame:
    """Link the kept neighbours of every node, and the node, to its smallest neighbour."""
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").filter(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of ``links`` (``a``, ``b``, both long).

    ``component`` is the smallest node that links reach. Links may repeat and come in
    either direction; links of a node to itself and links with a null end are ignored.
    """
    edges = (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .distinct()
    )
    edges = materialize(edges, "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a")).filter("a <> b").distinct()
        # small star: every node points its smaller neighbours, and itself, to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        edges, last = materialize(small, "links"), edges
        release(last)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = materialize(stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct()), "components")
    release(edges)
    return out
