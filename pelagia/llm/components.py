"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import materialize, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    linked = down.join(least, F.col("u") == F.col("w"))
    return linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("w", "m").toDF("a", "b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the edges a, b (long).

    No component is ever gathered in a task: each step is a minimum by key and a join, and every round is
    written to the shared folder, the round before it then deleted. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        before, edges = edges, materialize(_small_star(_large_star(edges)).where(F.col("a") != F.col("b")).distinct())
        release(before)
    out = materialize(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct()))
    release(edges)
    return out
