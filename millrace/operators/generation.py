"""Generation in turns: samples of each category until enough of them are accepted."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import prohibited_note, rejection_feedback, verdict
from millrace.operators.relational import acceptance, first_wins, take_per_group

#: Known texts that a request shows, and rejections that it quotes.
SHOWN, QUOTED = 20, 3
SAMPLES = "category string, sample string, turn int, pos int, accepted boolean, reasoning string"


def _notes(open_: DataFrame, seen: DataFrame, last: DataFrame) -> DataFrame:
    """The open categories with `prohibited`, a note of the first texts known, and `feedback`, the last turn's first
    rejections. Only what is shown is gathered per category; the rest is counted."""
    known = seen.groupBy("category").agg(F.count(F.lit(1)).alias("_n"))
    first = take_per_group(seen.withColumn("_o", F.struct("turn", "pos", "sample")), SHOWN, "_o", ("category",))
    shown = first.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("turn", "pos", "sample"))).alias("_s"))
    refused = take_per_group(last.where("NOT accepted AND reasoning <> ''"), QUOTED, "pos", ("category",))
    quoted = refused.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("pos", "accepted", "reasoning"))).alias("_q"))
    out = open_.join(known, "category", "left").join(shown, "category", "left").join(quoted, "category", "left")
    more = F.col("_n") - F.size("_s")
    note = F.concat(prohibited_note(F.col("_s.sample"), SHOWN), F.when(more > 0, F.concat(F.lit("\n… and "), more.cast("string"), F.lit(" more"))).otherwise(""))
    feedback = F.coalesce(rejection_feedback(F.col("_q"), QUOTED), F.lit(""))
    return out.withColumns({"prohibited": F.coalesce(note, F.lit("")), "feedback": feedback}).drop("_n", "_s", "_q")


def until_target(
    categories: DataFrame, ask: Callable[[DataFrame], DataFrame], parse: Callable[[Column], Column], check: Callable[[DataFrame], DataFrame], save: Callable[[DataFrame, str], DataFrame],
    *, target: int, per_request: int, existing: DataFrame | None = None, max_turns: int | None = None,
) -> DataFrame:
    """(category, sample, turn, pos, accepted, reasoning) of all turns.

    categories: one row per `category`, with any other columns. In each turn every open category is asked once; the
    request has `prohibited` and `feedback` beside the category's columns, and ask adds `reply`. parse gives a reply's
    samples. Those that the category has already (of earlier turns or `existing`), or that the reply repeats, go; check
    adds `reply` to the rest. A category closes when `target` of its samples are accepted, or when a turn brings
    nothing new; without max_turns there are three times the turns that the target needs at least. A sample whose check
    failed (`error`) is left out. save writes a step and reads it, so that a turn that is done is not asked again.
    """
    if target < 0 or per_request < 1:
        raise ValueError("target must be 0 or more, per_request 1 or more")
    spark, texts = categories.sparkSession, ("category", "sample", "turn", "pos")
    samples = last = spark.createDataFrame([], SAMPLES)
    seen = samples.select(*texts) if existing is None else existing.select("category", "sample", F.lit(-1).alias("turn"), F.lit(0).alias("pos")).distinct()
    open_ = categories
    for turn in range(3 * ceil(target / per_request) if max_turns is None else max_turns):
        told = ask(_notes(open_, seen, last)).withColumn("_items", parse(F.col("reply")))
        made = save(told.select("category", F.posexplode("_items").alias("pos", "sample")), f"generated-{turn}")
        fresh = first_wins(made.join(seen, ["category", "sample"], "left_anti").withColumn("_k", F.struct("category", "sample")), "_k", "pos").drop("_k")
        judged = check(fresh).where("error IS NULL").withColumn("_v", verdict("reply"))
        last = save(judged.select("category", "sample", F.lit(turn).alias("turn"), "pos", F.col("_v.accepted").alias("accepted"), F.col("_v.reasoning").alias("reasoning")), f"checked-{turn}")
        samples, seen = samples.unionByName(last), seen.unionByName(last.select(*texts))
        state = samples.groupBy("category").agg(F.count_if("accepted").alias("n"), F.max("turn").alias("last"))
        open_ = save(open_.join(state.where((F.col("n") < target) & (F.col("last") == turn)), "category", "left_semi"), f"open-{turn}")
        if open_.isEmpty():
            break
    return samples


def turn_totals(samples: DataFrame) -> DataFrame:
    """Per category and turn: extracted, accepted, rejected, rate."""
    return acceptance(samples, ("category", "turn"), F.col("accepted"))


def category_totals(samples: DataFrame) -> DataFrame:
    """Per category, over all turns: extracted, accepted, rejected, rate."""
    return acceptance(samples, ("category",), F.col("accepted"))
