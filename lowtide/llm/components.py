"""Connected components of a graph given as edge rows, by hooking and contraction.

Every round hooks each node to its least smaller neighbour, shortens the hooks
to roots by pointer jumping and contracts the edges to roots, so edges vanish in
a logarithmic number of rounds. Rounds are tables in the shared folder; joins
are between such tables, so a node with very many edges is split by adaptive
execution, and nothing but edge counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.sources.sinks import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for nodes of ``edges(a, b)`` that are not the least of their component; root is the least."""
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    labels = None
    while not edges.isEmpty():
        hooks = _flatten(stage(edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"), name), name)
        left = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        ends = edges.join(left, "a", "left").join(right, "b", "left").select(
            F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        edges = stage(ends.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        labels = hooks if labels is None else stage(_follow(labels, hooks).unionByName(
            hooks.join(labels, "node", "left_anti")), name)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return labels.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def _flatten(hooks: DataFrame, name: str) -> DataFrame:
    inner = hooks.join(hooks.select(F.col("node").alias("root")), "root", "left_semi")
    while not inner.isEmpty():
        hooks = stage(_follow(hooks, hooks), name)
        inner = hooks.join(hooks.select(F.col("node").alias("root")), "root", "left_semi")
    return hooks
