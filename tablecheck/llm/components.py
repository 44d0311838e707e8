"""Connected components of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.session import pin


def _downward(edges: DataFrame) -> DataFrame:
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return edges.distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's neighbours move to the least node around it. The large star
    moves the neighbours above a node, the small star those below it and the node itself.

    Both are a minimum by node, which combines before the shuffle, and a join back, whose hot
    nodes adaptive execution can split."""
    if large:
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        low = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = low.unionAll(least.select("a", F.col("m").alias("b")))
    return moved


def components(links: DataFrame) -> DataFrame:
    """(a, b): every node of `links` (a, b; any order) that is not the least of its component,
    with the least one. NULL ends are left out.

    Large and small stars alternate until nothing changes, in about log(nodes) rounds, each
    written as a table so that the lineage stays short."""
    edges = pin(_downward(links.filter("a is not null and b is not null")), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges
        before = state
        edges = pin(_downward(_star(_downward(_star(edges, large=True)), large=False)), "stars")
