"""Beam search over moves, all seeds at once: a frontier table that is expanded, scored and cut per seed and depth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def beam_search(seeds: DataFrame, moves: DataFrame, advance: Callable[[DataFrame], DataFrame], score: Callable[[DataFrame], DataFrame], save: Callable[[DataFrame, str], DataFrame], *, beam: int = 3, depth: int = 3, succeeded: Column | None = None) -> DataFrame:
    """The tree: seed_id, node, parent, depth, move, state, score, success, kept.

    seeds has seed_id and state, moves a small (move) table. advance turns rows (state, move) into new states, score
    adds `score`. A level keeps each seed's `beam` best by score, ties by the order they were made in; a seed with a
    success is not expanded further. Levels are written by save.
    """
    hit = F.coalesce(succeeded, F.lit(False)) if succeeded is not None else F.lit(False)
    columns = ("seed_id", "node", "parent", "depth", "move", "state", "score", "success", "kept")
    root = seeds.select("seed_id", F.lit("0").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("move"), "state", F.lit(0.0).alias("score"), F.lit(False).alias("success"), F.lit(True).alias("kept"))
    tree = level = save(root, "depth-0")
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m["move"]).alias("move")) for k, m in enumerate(moves.collect())])
    for d in range(1, depth + 1):
        grown = level.where("kept AND NOT success").select("seed_id", F.col("node").alias("parent"), "state", F.explode(listed).alias("m"))
        made = grown.select("seed_id", "parent", "state", F.col("m.move").alias("move"), F.concat("parent", F.lit("."), F.lpad(F.col("m.k").cast("string"), 3, "0")).alias("node"))
        scored = save(score(advance(made)).withColumn("success", hit), f"scored-{d}")
        place = F.row_number().over(Window.partitionBy("seed_id").orderBy(F.desc("score"), "node"))
        won = scored.where("success").select("seed_id").distinct()
        ranked = scored.withColumn("depth", F.lit(d)).withColumn("kept", place <= beam)
        level = ranked.join(won.withColumn("_w", F.lit(True)), "seed_id", "left").withColumn("kept", F.col("kept") & F.col("_w").isNull()).select(*columns)
        level = save(level, f"depth-{d}")
        if level.isEmpty():
            break
        tree = tree.unionByName(level)
    return tree


def best_nodes(tree: DataFrame) -> DataFrame:
    """Per seed the node of the highest score, of equals the deepest, then the one made first."""
    return tree.groupBy("seed_id").agg(F.max_by(F.struct("node", "depth", "move", "state", "score", "success"), F.struct("score", "depth", F.negative(F.length("node")))).alias("n")).select("seed_id", "n.*")
