"""Connected components of an edge table, by alternating star contractions.

Every round joins each node's neighbours to the smallest of them; a chain of n nodes is
done in about log2(n) rounds. Each round is staged, so the lineage stays short and
no part of the graph reaches the driver, which sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.session import staged


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges ``a > b``; ``large`` moves a node's larger neighbours, else the smaller."""
    pairs = edges
    if large:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = pairs.join(least.hint("merge"), F.col("a") == F.col("node"))
    moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))))
    return moved.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) for every node of ``edges(a, b)``, in any direction."""
    current = staged(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        current = staged(_starred(_starred(current, True), False), "edges")
    # Every edge now leads to its component.
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
