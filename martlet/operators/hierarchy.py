"""Tree helpers (E16): node -> ancestors list and the path between two nodes.

The walk doubles its reach with every round: a table of jumps over 1, 2, 4, ... parents is joined
to itself and to what is known so far, so a tree of any depth takes a logarithmic number of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def ancestors(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(node, ancestor, depth) rows: depth 0 is the node itself, then up to the root. A null
    parent marks a root. A cycle is an error."""
    e = cut_lineage(edges.select(F.col(node).alias("node"), F.col(parent).alias("parent")))
    jumps = e.filter("parent IS NOT NULL").select("node", F.col("parent").alias("to"))
    ids = e.select("node").union(jumps.select("to")).distinct()
    n_ids, step = ids.count(), 1
    known = ids.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))
    while not jumps.isEmpty():
        if step >= n_ids:
            raise ValueError("the edges have a cycle")
        further = known.select(F.col("node").alias("to"), "ancestor", (F.col("depth") + step).alias("depth"))
        known = cut_lineage(known.unionByName(jumps.join(further, "to").select("node", "ancestor", "depth")))
        second = jumps.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumps = cut_lineage(jumps.join(second, "to").select("node", F.col("next").alias("to")))
        step *= 2
    return known.join(e.select("node").distinct(), "node", "left_semi")


def tree_ancestors(edges: DataFrame, **kw) -> DataFrame:
    """``treeAncestors``: node -> array of ancestors from the node to the root."""
    a = ancestors(edges, **kw)
    return a.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "ancestor"))),
                                             lambda s: s["ancestor"]).alias("ancestors"))


def tree_path(edges: DataFrame, pairs: DataFrame, src: str = "src", dst: str = "dst", **kw) -> DataFrame:
    """``treePath``: nodes from src up to the lowest common ancestor and down to dst."""
    a = ancestors(edges, **kw)
    up = pairs.join(a.select(F.col("node").alias(src), F.col("ancestor").alias("_a"),
                             F.col("depth").alias("_du")), src)
    down = a.select(F.col("node").alias(dst), F.col("ancestor").alias("_a"), F.col("depth").alias("_dd"))
    common = up.join(down, [dst, "_a"])
    lca = common.groupBy(src, dst).agg(F.min_by(F.struct("_a", "_du", "_dd"), F.col("_du") + F.col("_dd")).alias("_l"))
    ua = a.select(F.col("node").alias(src), F.col("ancestor").alias("_n"), F.col("depth").alias("_d"))
    da = a.select(F.col("node").alias(dst), F.col("ancestor").alias("_n"), F.col("depth").alias("_d"))
    ups = lca.join(ua, src).filter(F.col("_d") <= F.col("_l._du")).select(src, dst, "_n", F.col("_d").alias("_k"))
    downs = lca.join(da, dst).filter(F.col("_d") < F.col("_l._dd")) \
               .select(src, dst, "_n", (F.lit(10_000) - F.col("_d")).alias("_k"))
    both = ups.unionByName(downs)
    return both.groupBy(src, dst).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_n"))),
                                                  lambda s: s["_n"]).alias("path"))
