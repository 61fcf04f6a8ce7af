"""Connected components of a table of links, by contraction.

Every node points to the least of itself and its neighbours in a scrambled order, pointers are
followed two steps further, and links are redrawn between what they point to. The scrambled order
makes long chains shrink by a constant share per round. Nodes and links stay in tables of the
shared folder; the driver only learns whether links are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settle import settle


def _scrambled(x: Column) -> Column:
    x = x.bitwiseXOR(F.shiftleft(x, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def _undirected(u: Column, v: Column, edges: DataFrame) -> DataFrame:
    return edges.where(u != v).select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of long ids: ``node``, ``component`` (least id reachable), for nodes that have links."""
    links = settle(links.select("a", "b").where(F.col("a") != F.col("b")), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = nodes.select("node", _scrambled(F.col("node")).alias("at"))
    edges = settle(_undirected(_scrambled(F.col("a")), _scrambled(F.col("b")), links), "edges")
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to")), "pointers")
        on = least.select(F.col("u").alias("from"), F.col("to").alias("next"))
        hop = least
        for _ in range(2):
            hop = hop.join(on, F.col("to") == F.col("from"), "left").select("u", F.coalesce("next", "to").alias("to"))
        hop = settle(hop, "pointers")
        end = hop.select(F.col("u").alias("v"), F.col("to").alias("v_to"))
        edges = settle(_undirected(F.col("to"), F.col("v_to"), edges.join(hop, "u").join(end, "v")), "edges")
        on = hop.select(F.col("u").alias("at"), "to")
        labels = labels.join(on, "at", "left").select("node", F.coalesce("to", "at").alias("at"))
    labels = settle(labels, "labels")
    root = labels.groupBy("at").agg(F.min("node").alias("component"))
    return labels.join(root, "at").select("node", "component")
