"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize

# Links of a round up to which its maps are broadcast.
BROADCAST_LINKS = 100_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in a link; the component is its least node.

    Each round maps every node to the least of itself and its neighbours and
    contracts the links accordingly, until none is left; the maps are then
    applied one after the other. All tables stay distributed and are written
    once per round, so lost executors cost no earlier round.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = materialize(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    maps = []
    while count := edges.count():
        small = F.broadcast if count <= BROADCAST_LINKS else lambda df: df
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("next"))
        least = materialize(least, "least")
        maps.append(small(least))
        left = least.select(F.col("node").alias("u"), F.col("next").alias("u2"))
        right = least.select(F.col("node").alias("v"), F.col("next").alias("v2"))
        moved = edges.join(small(left), "u").join(small(right), "v").where("u2 <> v2")
        edges = materialize(moved.select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("u").alias("component"))
    found = maps[0].select("node", F.col("next").alias("component"))
    for step in maps[1:]:
        further = step.select(F.col("node").alias("component"), "next")
        found = found.join(further, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return materialize(found, "components")
