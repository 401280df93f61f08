"""Connected components of a graph of 64-bit ids by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """edges (u, v) of bigints to (node, component), component being the smallest id that node reaches.

    Only nodes other than their component have a row. Loops and repeated edges are ignored. Each round is written to
    the shared folder; a round is two joins whose sides are an aggregate and edges, so a node with very many edges is
    split like any skewed join. The number of rounds grows with the logarithm of a component's size.
    """

    def clean(e: DataFrame) -> DataFrame:
        return e.where("u <> v").groupBy("u", "v").agg(F.lit(1).alias("_")).drop("_")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    current = materialise(clean(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), label)
    seen = mark(current)
    while seen[0]:
        current = materialise(clean(_small_star(clean(_large_star(current)))), label)
        now = mark(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
