"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _stars(links: DataFrame, upward_only: bool) -> DataFrame:
    """Every neighbour of a node is linked to the smallest of its neighbourhood.

    ``links`` has ``hi`` > ``lo``. With ``upward_only`` a node looks at its smaller
    neighbours only, and is linked itself; else larger neighbours are re-linked. The
    smallest are written first, so that the join has two plain sides and a node with
    very many links can be split by the adaptive skew join.
    """
    if upward_only:
        seen = links.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
    else:
        seen = links.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
            links.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
    least = materialise(
        seen.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least")), "least"
    )
    moved = (seen if upward_only else seen.where("other > node")).join(least, "node").select(F.col("other").alias("hi"), F.col("least").alias("lo"))
    if upward_only:
        moved = moved.unionByName(least.select(F.col("node").alias("hi"), F.col("least").alias("lo")))
    return materialise(moved.where("hi <> lo").distinct(), "stars")


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node of ``links`` (a, b).

    Repeated, reversed and self links are allowed; self links alone make no node.
    Large and small stars alternate until nothing changes; each step is a table in
    the shared folder, so lineage stays short and a lost executor costs one step.
    """
    now = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links"
    )
    mark = None
    while True:
        now = _stars(_stars(now, upward_only=False), upward_only=True)
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
