"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document is to be taken m = target / source_size times (at most `cap`). Its whole part is certain; the
fractional parts are rounded in pairs: one of two documents gives words to the other, at random and without bias,
until one of the two counts is integral. Each step keeps the expected copies of every document and, exactly, the
words taken from the source, so that a source ends within one document of its target.

The pairing is a reduction tree. The fractional documents of a source are dealt by a hash of their identity into
chunks of about `fan_in`; a fold over a chunk leaves one fractional document at most, and the residuals of all chunks
are the next, smaller level. Levels are written to the shared folder, so a lost executor repeats a part of one level.
A hot source is just a source with more chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._common import WORD_PATTERN, materialise, table

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)

_ITEM = "struct<k:bigint,doc_id:bigint,size:bigint,whole:bigint,p:double>"

# One step of the fold. acc.c is the fractional document in hand (null at first), x the next one. Words move from x to
# acc.c with probability `down / (up + down)`, else the other way; the document that reaches 0 or 1 is finished.
_STEP = """
(acc, x) -> CASE WHEN acc.c IS NULL THEN named_struct('c', x, 'done', acc.done) ELSE
  element_at(transform(array(named_struct(
      'up', least((1 - acc.c.p) * acc.c.size, x.p * x.size),
      'down', least(acc.c.p * acc.c.size, (1 - x.p) * x.size),
      'u', (pmod(xxhash64({seed}, acc.c.k, x.k, acc.c.p), 1048576) + 0.5) / 1048576)), m ->
    element_at(transform(array(IF(m.u * (m.up + m.down) < m.down,
      named_struct('a', IF((1 - acc.c.p) * acc.c.size <= x.p * x.size, 1D, acc.c.p + m.up / acc.c.size),
                   'b', IF(x.p * x.size <= (1 - acc.c.p) * acc.c.size, 0D, x.p - m.up / x.size)),
      named_struct('a', IF(acc.c.p * acc.c.size <= (1 - x.p) * x.size, 0D, acc.c.p - m.down / acc.c.size),
                   'b', IF((1 - x.p) * x.size <= acc.c.p * acc.c.size, 1D, x.p + m.down / x.size)))), n ->
      named_struct(
        'c', CASE WHEN n.a > 0 AND n.a < 1 THEN {with_a} WHEN n.b > 0 AND n.b < 1 THEN {with_b} END,
        'done', concat(acc.done,
          IF(n.a > 0 AND n.a < 1, {none}, array({with_a})),
          IF(n.b > 0 AND n.b < 1 AND NOT (n.a > 0 AND n.a < 1), {none}, array({with_b}))))), 1)), 1) END
"""


def _fold(items: str, seed: int) -> str:
    with_p = "named_struct('k', {0}.k, 'doc_id', {0}.doc_id, 'size', {0}.size, 'whole', {0}.whole, 'p', {1})"
    none = f"CAST(array() AS array<{_ITEM}>)"
    step = _STEP.format(seed=f"{seed}L", none=none, with_a=with_p.format("acc.c", "n.a"), with_b=with_p.format("x", "n.b"))
    return f"aggregate({items}, named_struct('c', CAST(NULL AS {_ITEM}), 'done', {none}), {step})"


def source_targets(sizes: DataFrame, *, share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per source (null counts as one, last in order): source_size, n_fractional candidates and target.

    The targets are min(cap * size, level * weight) with the one level at which they add up to share * all sizes: that
    is where re-sharing the excess by weight ends. It is found from running sums over the sources, ordered by the level
    at which each is filled.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    return (
        per.withColumn("w", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("room", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
        .withColumn("level", F.col("room") / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(filled), F.lit(0.0))))
        .withColumn("level", F.max("level").over(everything))
        .select("source", "source_size", "n", F.least(F.col("cap"), F.col("level") * F.col("w")).alias("target"))
    )


def mix(docs: DataFrame, *, share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS, seed: int = 11, fan_in: int = 48) -> DataFrame:
    """Returns a row per row of docs: doc_id, size, source_size, target, taken, copies.

    Reads doc_id, text and source; other columns are ignored whatever their names. size is the number of words (null
    or empty text: 0). A null source is one source, after all others. Rows without words are taken 0 words. Repeated
    rows are rows of their own. An empty table gives an empty result. The same rows and seed give the same result in
    any order and partitioning; for this, chance comes from hashes of (doc_id, text).
    """
    sizes = materialise(
        docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("k")),
        "mix-sizes",
    )
    targets = materialise(source_targets(sizes, share=share, cap=cap, weights=weights), "mix-targets")
    joined = sizes.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    times = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    level = joined.select("d.source", "doc_id", "size", "source_size", "target", "n", "k", F.floor(times).cast("bigint").alias("whole"), (times - F.floor(times)).alias("p"))
    keys = ("source", "source_size", "target", "n")
    finished, level = [level.where("p = 0")], level.where("p > 0")
    depth = 0
    most = targets.agg(F.max("n")).first()[0] or 0
    while most:
        # n becomes the number of the source's chunks here, and so a bound on the next level's documents.
        last = most <= fan_in
        chunks = F.ceil(F.col("n") / fan_in).cast("bigint")
        folded = materialise(
            level.withColumn("n", chunks)
            .groupBy(*keys, F.pmod(F.xxhash64(F.lit(seed + depth), "k"), F.col("n")).alias("chunk"))
            .agg(F.sort_array(F.collect_list(F.struct("k", "doc_id", "size", "whole", "p"))).alias("items"))
            .select(*keys, F.expr(_fold("items", seed + depth)).alias("f")),
            f"mix-level{depth}",
        )
        finished.append(folded.select("*", F.inline("f.done")).drop("f"))
        level = folded.where("f.c IS NOT NULL").select(*keys, "f.c.*")
        most, depth = (0 if last else -(-most // fan_in)), depth + 1
    # what is left of a source, one document at most, goes up with its own probability
    chance = (F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "k"), F.lit(1048576)) + 0.5) / 1048576
    finished.append(level.withColumn("p", F.when(chance < F.col("p"), 1.0).otherwise(0.0)))
    columns = ["doc_id", "size", "source_size", "target", F.expr("(whole + CAST(p AS bigint)) * size").alias("taken"), F.expr("whole + CAST(p AS bigint)").alias("copies")]
    out = finished[0].select(*columns)
    for part in finished[1:]:
        out = out.unionAll(part.select(*columns))
    return out


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
