"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of each node that has a link.

    Each round sends every node to its smallest neighbour, shortens the paths, and contracts the links;
    each connected piece at least halves its nodes, so rounds grow with the logarithm of its size. Every
    round is cut by a written table; only the last labels stay. Nothing is collected but whether links remain.
    """
    scratch = Scratch(links.sparkSession, "components")
    edges = scratch.put(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    labels = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = scratch.put(both.groupBy("a").agg(F.min("b").alias("_b")).select(F.col("a").alias("node"), F.least("a", "_b").alias("to")), "parents")
        for _ in range(2):
            up = step.select(F.col("node").alias("to"), F.col("to").alias("_up"))
            step = scratch.put(step.join(up, "to").select("node", F.col("_up").alias("to")), "parents")
        if labels is None:
            labels = scratch.put(step.select("node", F.col("to").alias("component")), "labels")
        else:
            up = step.select(F.col("node").alias("component"), F.col("to").alias("_to"))
            labels = scratch.put(labels.join(up, "component", "left").select("node", F.coalesce("_to", "component").alias("component")), "labels")
        to_a, to_b = step.toDF("a", "_a"), step.toDF("b", "_b")
        edges = scratch.put(edges.join(to_a, "a").join(to_b, "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).where("a <> b").distinct(), "links")
    if labels is None:
        labels = scratch.put(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "labels")
    scratch.drop_all_but(labels)
    return labels
