"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.llm.stages import Stages, salted_join


def _hang(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: hangs a node's neighbours on the smallest of them and itself.

    Large star: every neighbour larger than the node; small star: the smaller ones and
    the node itself."""
    if larger_only:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        moved = salted_join(both.filter("v > u"), low, ["u"], "v").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:  # edges point from the larger to the smaller node
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        joined = salted_join(edges, low, ["u"], "v")
        moved = (joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .union(low.select("u", F.col("low").alias("v"))))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """(id, component) of every node of ``links`` (columns a, b): the smallest node it can reach.  Written as ``name``.

    Ends when a round changes nothing, in about log2 of the longest path rounds."""
    edges = stages.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .filter("u <> v").distinct(), f"{name}-0")
    before, at = None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if state == before or state["n"] == 0:
            break
        before, at = state, at + 1
        edges = stages.write(_hang(_hang(edges, True), False), f"{name}-{at}")
        stages.remove(f"{name}-{at - 1}")
    found = stages.write(edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
                         .union(edges.select("v", "v").distinct()), name)
    stages.remove(f"{name}-{at}")
    return found
