"""Connected components of a graph given as links, as a loop of joins and minima.

Links turn into stars: every node is linked to the smallest node it is known to be connected with,
first through its larger neighbours and then through its smaller ones, until nothing changes. Each
round is cut with a checkpoint in the shared folder. A hub is never gathered in one task: minima
are summed before the shuffle and the join may split a hot key.
"""
from pyspark.sql import functions as F

from ..staging import checkpointed
from .common import apart


def components(links):
    """(node, component) for the nodes of the links (a, b); the component is its smallest node.

    Links of a node to itself and with nulls are ignored; repeated links do not matter.
    """
    ordered = F.array_sort(F.array("a", "b"))
    edges = (links.where("a <> b").select(ordered[1].alias("u"), ordered[0].alias("v")).distinct())
    edges, state = _settled(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(apart(least), "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(apart(least), "u")
        edges = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges, after = _settled(edges)
        if after == state:
            break
        state = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _settled(edges):
    """The links, kept in the shared folder, and what tells whether a round changed them."""
    edges = checkpointed(edges)
    state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return edges, tuple(state)
