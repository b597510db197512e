"""Connected components of an edge table, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b): ``label`` is the least node of the component.

    Every node hooks onto its least smaller neighbour, chains are shortened to their roots by
    joining the hooks with themselves, and the edges are rewritten between roots, until none is left.
    """
    left = stored(_between(edges, "a", "b"))
    if left.isEmpty():
        return left.select(F.col("high").alias("node"), F.col("low").alias("label"))
    labels = None
    while True:
        hooks = left.groupBy("high").agg(F.min("low").alias("root")).withColumnRenamed("high", "node")
        while True:
            hooks = stored(_jumped(_jumped(hooks)))
            above = hooks.select(F.col("node").alias("root"))
            if hooks.join(above, "root", "left_semi").isEmpty():
                break
        up = hooks.select(F.col("node").alias("_from"), F.col("root").alias("_to"))
        if labels is None:
            labels = hooks.select("node", F.col("root").alias("label"))
        else:  # every node of the edges left is a root of before, so it has no row among the labels yet
            moved = labels.join(up, labels["label"] == up["_from"], "left").select("node", F.coalesce("_to", "label").alias("label"))
            labels = stored(moved.union(hooks.select("node", F.col("root").alias("label"))))
        ends = (left.join(up, left["high"] == up["_from"], "left").select("low", F.coalesce("_to", "high").alias("high"))
                .join(up, F.col("low") == up["_from"], "left").select("high", F.coalesce("_to", "low").alias("low")))
        left = stored(_between(ends, "high", "low"))
        if left.isEmpty():
            roots = labels.select(F.col("label").alias("node"), "label").distinct()
            return labels.union(roots)


def _jumped(hooks: DataFrame) -> DataFrame:
    above = hooks.select(F.col("node").alias("root"), F.col("root").alias("_up"))
    return hooks.join(above, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links`` (a, b), whose nodes need not have a label yet."""
    def named(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"_{side}"))

    between = (links.join(named("a"), "a", "left").join(named("b"), "b", "left")
               .select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
    up = stored(components(between)).select(F.col("node").alias("_from"), F.col("label").alias("_to"))
    moved = labels.join(up, labels["label"] == up["_from"], "left").select("node", F.coalesce("_to", "label").alias("label"))
    fresh = up.join(labels.select(F.col("node").alias("_from")), "_from", "left_anti")
    return stored(moved.union(fresh.select(F.col("_from").alias("node"), F.col("_to").alias("label"))))


def _between(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).filter("high <> low").distinct()
