"""Connected components of an edge table by hooking and pointer doubling.

Each round hooks every node to the smallest node among itself and its neighbours. The pointers
only go to smaller nodes, so they form trees; doubling (a node takes its target's target) brings
every node to its root in as many steps as the depth has binary digits. Then the edges are
rewritten between roots, and loops and repeats go. Roots are no neighbours of each other, and
every other node disappears, so at least half of the nodes go per round: a chain of n edges takes
one hooking round and log2(n) doublings if its ids rise, and in any order rounds and doublings
are logarithmic. All steps are aggregations with partial sums and joins whose other side has one
row per node (a hub's rows split); each is a written table, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges (u, v)`` to ``(node, component)`` for every node of an edge; the component is
    its smallest node. Loops, repeats and both directions are allowed; NULL ends are not."""
    edges = materialize(_clean(edges.select("u", "v")))
    nodes = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooked = both.groupBy("u").agg(F.min("v").alias("v")).select(
            F.col("u").alias("node"), F.least("u", "v").alias("component"))
        roots = _doubled(materialize(hooked))
        nodes = roots if nodes is None else materialize(_compose(nodes, roots))
        edges = materialize(_clean(_mapped(_mapped(edges, roots, "u"), roots, "v")))
    if nodes is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes


def _doubled(pointers: DataFrame) -> DataFrame:
    """Pointers of a forest, each moved on to the root of its tree."""
    while True:
        target = pointers.select(F.col("node").alias("component"), F.col("component").alias("__to"))
        made = materialize(
            pointers.join(target, "component")
            .select("node", F.col("__to").alias("component"), (F.col("__to") < F.col("component")).alias("__moved")))
        pointers = made.select("node", "component")
        if made.filter("__moved").isEmpty():
            return pointers


def _clean(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct()


def _mapped(edges: DataFrame, roots: DataFrame, end: str) -> DataFrame:
    to = roots.select(F.col("node").alias(end), F.col("component").alias("__to"))
    return edges.join(to, end).drop(end).withColumnRenamed("__to", end)


def _compose(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    to = roots.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    return nodes.join(to, "component", "left").select("node", F.coalesce("__to", "component").alias("component"))
