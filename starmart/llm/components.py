"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import written


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, label) for every node with a link; label is the smallest node it can reach.

    links: (a, b), in any order, repeats and a = b allowed. Every round hangs each node's
    larger neighbours, then its smaller ones, on its smallest neighbour, until nothing moves:
    a logarithmic number of rounds however long the chains are. A node with very many links
    is only ever aggregated (minimum) and joined.
    """
    edges = links.select("a", "b").where("a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), f"{folder}/edges")
    state, turn = None, 0
    while True:
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        state, turn = now, turn + 1
        edges = written(_small_star(_large_star(edges)), f"{folder}/edges-{turn}")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select(F.col("a").alias("hub"), F.least("a", "low").alias("low"))
    moved = both.where("b > a").join(least, F.col("a") == F.col("hub"))
    return moved.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least.withColumnRenamed("a", "hub"), F.col("a") == F.col("hub"))
    moved = moved.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()
