"""Keyed and grouped operators of a dataset build: dedup, caps, semi- and anti-joins, unions, counts, coverage."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import content_id
from millrace.functions.text import accepted_cell


def first_wins(rows: DataFrame, key: Column | str, order: str) -> DataFrame:
    """The first row of each key by `order`. Partial aggregation leaves a row per key and task before the shuffle."""
    columns = rows.columns
    packed = F.struct(*[F.col(c) for c in columns])
    best = rows.groupBy((F.col(key) if isinstance(key, str) else key).alias("_key")).agg(F.min_by(packed, F.col(order)).alias("_row"))
    return best.select("_row.*")


def take_per_group(rows: DataFrame, n: int | None, order: str, group_by: tuple[str, ...] = ("category", "entry_type")) -> DataFrame:
    """The first n rows of each group by `order`; rows with a null in the group's columns go. Without n all rows, and
    without any of the columns the first n of all. Groups are limited within partitions before they are shuffled."""
    if n is None:
        return rows
    held = [c for c in group_by if c in rows.columns]
    if not held:
        return rows.orderBy(order).limit(n)
    known = rows.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in held]))
    return known.withColumn("_n", F.row_number().over(Window.partitionBy(*held).orderBy(order))).where(F.col("_n") <= n).drop("_n")


def append_new(existing: DataFrame, batch: DataFrame, *, text: str, order: str) -> DataFrame:
    """The rows of batch to append: those whose content id is new, the first of each."""
    keyed = batch.withColumn("sample_id", content_id(text))
    return first_wins(keyed.join(existing.select("sample_id"), "sample_id", "left_anti"), "sample_id", order)


def pending(plan: DataFrame, inputs: DataFrame, acks: DataFrame, keys: tuple[str, ...] = ("sample_id", "iteration")) -> DataFrame:
    """Planned units whose input is there and which aren't acknowledged."""
    return plan.join(inputs.select("sample_id"), "sample_id", "left_semi").join(acks.select(*keys), list(keys), "left_anti")


def last_input(inputs: DataFrame, order: str, key: str = "sample_id") -> DataFrame:
    """One row per id, the last by `order`: what a lookup by id finds."""
    return inputs.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in inputs.columns if c != key]), order).alias("_row")).select(key, "_row.*")


def with_iterations(inputs: DataFrame, iterations: int) -> DataFrame:
    """Every row once per iteration: a generator, no join."""
    return inputs.withColumn("iteration", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))) if iterations > 0 else F.explode(F.array().cast("array<int>")))


@dataclass(frozen=True)
class Part:
    """A source of the union: its rows, their tag, and whether only accepted rows count."""

    rows: DataFrame
    dataset_type: str
    accepted_only: bool = False


def union_parts(parts: list[Part]) -> DataFrame:
    """All parts by column name, in order of first appearance, missing columns null, tagged by dataset_type."""

    def one(part: Part) -> DataFrame:
        rows = part.rows.where(accepted_cell("accepted")) if part.accepted_only and "accepted" in part.rows.columns else part.rows
        return rows.withColumn("dataset_type", F.lit(part.dataset_type))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, parts))


def file_counts(rows: DataFrame, keep: dict[str, object] | None = None, accepted: str | None = "accepted") -> DataFrame:
    """One row: how many rows match `keep`, and how many of them are accepted (null without such a column)."""
    for name, value in (keep or {}).items():
        rows = rows.where(F.col(name) == F.lit(value))
    yes = F.count_if(accepted_cell(accepted)) if accepted and accepted in rows.columns else F.lit(None).cast("bigint")
    return rows.agg(F.count(F.lit(1)).alias("rows"), yes.alias("accepted"))


def most_common(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """The values of a column by how many rows have them, the most frequent first, ties by value; n of them if given."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return counted if n is None else counted.limit(n)


def acceptance(rows: DataFrame, by: tuple[str, ...], accepted: Column) -> DataFrame:
    """Per group: extracted, accepted, rejected and the rate (0 for none)."""
    held = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("extracted"), F.count_if(accepted).alias("n_accepted"))
    return held.withColumn("n_rejected", F.col("extracted") - F.col("n_accepted")).withColumn("rate", F.coalesce(F.try_divide("n_accepted", "extracted"), F.lit(0.0)))


def lineage(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Rows of children with their parent's row as `parent` (input_id = sample_id)."""
    return children.alias("c").join(parents.select(F.col("sample_id").alias("_pid"), F.struct("*").alias("parent")), F.col("input_id") == F.col("_pid")).drop("_pid")


def coverage(plan: DataFrame, registry: DataFrame) -> DataFrame:
    """Counts of a plan's combinations per (level, name, category, entry_type, iteration), level being layer, family or
    technique, and a zero row for every technique of the registry that was never drawn. One pass over the plan: each
    pick is counted before the three levels are told apart."""
    groups = ("category", "entry_type", "iteration")
    picks = plan.select(*groups, F.explode("combination").alias("technique")).groupBy("technique", *groups).agg(F.count(F.lit(1)).alias("n"))
    known = picks.join(registry.select("technique", F.get(F.col("families"), F.lit(0)).alias("family"), "layer"), "technique", "left")
    levels = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.col(level).alias("name")) for level in ("layer", "family", "technique")])).alias("l")
    counted = known.select(levels, *groups, "n").where("l.name IS NOT NULL").groupBy("l.level", "l.name", *groups).agg(F.sum("n").alias("count"))
    never = registry.select("technique").join(picks.select("technique"), "technique", "left_anti")
    return counted.unionByName(never.select(F.lit("technique").alias("level"), F.col("technique").alias("name"), F.lit(0).cast("bigint").alias("count")), allowMissingColumns=True)


def deal_targets(rows: DataFrame, rate: float, offset: Column, order: str, by: tuple[str, ...]) -> DataFrame:
    """Whether each row of a group, in order, takes a layer of this rate: the group gets rate * size picks, rounded by
    the offset, spread evenly. The closed form of dealing, as long as every due pick finds a technique."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    due = lambda p: F.floor(F.lit(rate) * p + offset)
    return rows.withColumn("position", place).withColumn("include", due(F.col("position")) > due(F.col("position") - 1))
