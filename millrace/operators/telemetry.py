"""Roll-ups of call events: usage and cost per model, rate windows, time covered by intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Backends that cost no money per token.
LOCAL_BACKENDS = ("vllm", "introspection")


#: A call event as usage() reads it.
EVENT = "ev string, stage string, model string, backend string, n_items bigint, in_tok bigint, out_tok bigint, ms double, cut boolean, error string"


def append_events(events: DataFrame, path: str) -> None:
    """Adds events to a trace of JSON lines; null fields are left out of their lines."""
    events.write.mode("append").json(path)


def read_trace(spark: SparkSession, path: str, schema: str = EVENT) -> DataFrame:
    """The events of a trace."""
    return spark.read.schema(schema).json(path)


def usage(events: DataFrame, prices: DataFrame) -> DataFrame:
    """Per model: calls, items, tokens, milliseconds, replies cut, errors, and cost_usd of its hosted calls.

    prices: (model, price_in, price_out) per million tokens. The cost is null where the model has no hosted call or no
    price, and a missing price of two counts as 0.
    """
    hosted = ~F.coalesce(F.col("backend").isin(*LOCAL_BACKENDS), F.lit(False))
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    rolled = (
        events.where("ev = 'call'")
        .groupBy(F.coalesce("model", F.lit("?")).alias("model"))
        .agg(
            F.count(F.lit(1)).alias("calls"),
            total("n_items").alias("items"),
            total("in_tok").alias("in_tok"),
            total("out_tok").alias("out_tok"),
            total("ms").alias("ms"),
            F.count_if(F.coalesce("cut", F.lit(False))).alias("cut"),
            F.count_if(F.col("error").isNotNull()).alias("errors"),
            F.count_if(hosted).alias("hosted"),
            F.sum(F.when(hosted, F.coalesce("in_tok", F.lit(0))).otherwise(0)).alias("_in"),
            F.sum(F.when(hosted, F.coalesce("out_tok", F.lit(0))).otherwise(0)).alias("_out"),
        )
    )
    cost = F.col("_in") / 1e6 * F.coalesce("price_in", F.lit(0.0)) + F.col("_out") / 1e6 * F.coalesce("price_out", F.lit(0.0))
    priced = (F.col("hosted") > 0) & (F.col("price_in").isNotNull() | F.col("price_out").isNotNull())
    return rolled.join(prices, "model", "left").withColumn("cost_usd", F.when(priced, F.round(cost, 4))).drop("_in", "_out", "price_in", "price_out")


def total_cost(per_model: DataFrame) -> DataFrame:
    """One row: the cost of all models; 0 when every call was local, null when no priced model was called."""
    return per_model.agg(F.when(F.count("cost_usd") > 0, F.round(F.sum("cost_usd"), 4)).when((F.count(F.lit(1)) > 0) & (F.sum("hosted") == 0), 0.0).alias("cost_usd"))


def cut_replies(events: DataFrame) -> DataFrame:
    """Replies cut at the token limit, per stage and model."""
    return events.where("ev = 'call' AND cut").groupBy("stage", F.coalesce("model", F.lit("?")).alias("model")).agg(F.count(F.lit(1)).alias("n"))


def hourly_rate(gpus: DataFrame, rates: DataFrame) -> DataFrame:
    """gpus (provider, gpu) with the rate of (provider, gpu), else of ('*', gpu)."""
    own = rates.select("provider", "gpu", F.col("rate").alias("_own"))
    general = rates.where("provider = '*'").select("gpu", F.col("rate").alias("_any"))
    return gpus.join(own, ["provider", "gpu"], "left").join(general, "gpu", "left").withColumn("rate", F.coalesce("_own", "_any")).drop("_own", "_any")


def window_count(events: DataFrame, seconds: int, by: tuple[str, ...], ts: str = "ts") -> DataFrame:
    """Events of the same group in the window of so many seconds that ends at each event, the event included; one that
    is exactly `seconds` older is outside."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    frame = Window.partitionBy(*by).orderBy(micros).rangeBetween(-(seconds * 1_000_000 - 1), 0)
    return events.withColumn("in_window", F.count(F.lit(1)).over(frame))


def covered_seconds(spans: DataFrame, start: Column, end: Column, by: tuple[str, ...]) -> DataFrame:
    """The time that a group's spans cover, overlaps counted once: each span adds what reaches beyond all before it."""
    rows = spans.select(*by, start.alias("_s"), end.alias("_e")).where("_s IS NOT NULL AND _e IS NOT NULL")
    before = Window.partitionBy(*by).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("_e").over(before)
    new = F.greatest(F.col("_e") - F.greatest(F.col("_s"), F.coalesce(reached, F.col("_s"))), F.lit(0).cast("double"))
    return rows.withColumn("_new", new).groupBy(*by).agg(F.sum("_new").alias("covered_s"))
