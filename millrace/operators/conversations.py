"""Transcripts: ordered steps of a conversation as an array column, the turn loop, and judging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import MESSAGE, is_accepted

STEP = "struct<type:string,actor:string,content:string,role:string,model:string,meta:map<string,string>>"
#: Types of steps that other actors see.
VISIBLE = ("message",)


def parse_transcript(text: Column | str) -> Column:
    """Steps of a JSON column; an invalid one has none."""
    return F.coalesce(F.from_json(text, f"array<{STEP}>", {"mode": "PERMISSIVE"}), F.expr(f"CAST(array() AS array<{STEP}>)"))


def step(kind: str, actor: str, content: Column, role: str | None, model: Column | str | None = None) -> Column:
    given = model if isinstance(model, Column) else F.lit(model).cast("string")
    return F.struct(F.lit(kind).alias("type"), F.lit(actor).alias("actor"), content.alias("content"), F.lit(role).cast("string").alias("role"), given.alias("model"), F.expr("CAST(map() AS map<string,string>)").alias("meta"))


def visible(steps: Column) -> Column:
    return F.filter(steps, lambda s: s["type"].isin(*VISIBLE))


def as_messages(steps: Column, system: Column | None = None) -> Column:
    shown = F.transform(visible(steps), lambda s: F.struct(s["role"].alias("role"), s["content"].alias("content")))
    if system is None:
        return shown
    head = F.when(F.coalesce(system, F.lit("")) != "", F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))).otherwise(F.expr(f"CAST(array() AS array<{MESSAGE}>)"))
    return F.concat(head, shown)


def render(steps: Column) -> Column:
    """`role: content` lines of the visible steps."""
    return F.array_join(F.transform(visible(steps), lambda s: F.concat(s["role"], F.lit(": "), s["content"])), "\n")


def first_message(steps: Column) -> Column:
    return F.coalesce(F.get(F.filter(visible(steps), lambda s: s["role"] == "user"), F.lit(0))["content"], F.lit(""))


def last_reply(steps: Column) -> Column:
    return F.coalesce(F.element_at(F.concat(F.array(F.struct(F.lit("").alias("content"))), F.transform(F.filter(visible(steps), lambda s: s["role"] == "assistant"), lambda s: F.struct(s["content"].alias("content")))), -1)["content"], F.lit(""))


def edges_of_turns(turns: DataFrame) -> DataFrame:
    """Per conv_id the first user text and the last assistant text, by turn: two aggregates, no sort of conversations."""
    return turns.groupBy("conv_id").agg(F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias("first_message"), F.max_by(F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.col("turn"))).alias("last_reply"))


def render_turns(turns: DataFrame) -> DataFrame:
    """Per conv_id the transcript as `role: text` lines in order of turn."""
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))))
    return turns.where("text IS NOT NULL").groupBy("conv_id").agg(lines.alias("l")).select("conv_id", F.array_join(F.col("l.line"), "\n").alias("transcript"))


Reply = Callable[[DataFrame], DataFrame]


def converse(seeds: DataFrame, propose: Callable[[Column, int], Column], reply: Reply, save: Callable[[DataFrame, str], DataFrame], *, max_turns: int, stop: Callable[[Column], Column] | None = None, iterations: int = 1) -> DataFrame:
    """Conversations of seeds (input_id, text): each turn the proposer's message (null ends it) and the model's reply.

    propose(steps, turn) is an expression; the first message is the seed. reply adds `reply` and `error` to rows with
    `steps`. Turns are written by save, so that the plan doesn't grow with them. Result: input_id, iteration, steps,
    turns_used, stop_reason (stopped, exhausted, max_turns, or ERROR: ...).
    """
    state = seeds.withColumn("iteration", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1)))).withColumn("steps", F.expr(f"CAST(array() AS array<{STEP}>)")).withColumn("turns_used", F.lit(0)).withColumn("stop_reason", F.lit(None).cast("string"))
    columns = state.columns
    for turn in range(max_turns):
        said = F.col("text") if turn == 0 else propose(F.col("steps"), turn)
        active = state.where("stop_reason IS NULL").withColumn("_m", said)
        over = active.where("_m IS NULL").drop("_m").withColumn("stop_reason", F.lit("exhausted"))
        asked = active.where("_m IS NOT NULL").withColumn("steps", F.concat("steps", F.array(step("message", "user", F.col("_m"), "user")))).drop("_m")
        answered = reply(asked)
        grown = F.when(F.col("error").isNull(), F.concat("steps", F.array(step("message", "assistant", F.col("reply"), "assistant")))).otherwise(F.expr(f"CAST(array() AS array<{STEP}>)"))
        moved = answered.withColumn("steps", grown).withColumn("turns_used", F.lit(turn + 1))
        reason = F.when(F.col("error").isNotNull(), F.concat(F.lit("ERROR: "), F.col("error")))
        if stop is not None:
            reason = reason.when(stop(F.col("steps")), "stopped")
        moved = moved.withColumn("stop_reason", reason.when(F.lit(turn + 1 == max_turns), "max_turns")).select(*columns)
        state = save(state.where("stop_reason IS NOT NULL").unionByName(over.select(*columns)).unionByName(moved), f"turn-{turn}")
        if state.where("stop_reason IS NULL").isEmpty():
            break
    return state


def scripted(script: list[str]) -> Callable[[Column, int], Column]:
    """A proposer that says a script and then repeats its last line."""
    return lambda steps, turn: F.lit(script[min(turn - 1, len(script) - 1)]) if script else F.lit(None).cast("string")


def judge(conversations: DataFrame, ask: Reply, *, scope: str = "last_reply") -> DataFrame:
    """Adds success and judge_reasoning: ask adds `reply` to rows with `judged`, the last reply or the whole transcript."""
    shown = last_reply(F.col("steps")) if scope == "last_reply" else render(F.col("steps"))
    answered = ask(conversations.withColumn("judged", shown))
    return answered.withColumn("success", is_accepted("reply")).withColumn("judge_reasoning", F.coalesce("reply", F.lit(""))).withColumn("scope", F.lit(scope)).drop("reply", "judged")
