"""Structured Streaming forms of the run's state: commits by micro-batch, arrival-order dedup, usage and rate windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.keys import content_id
from millrace.operators.ledger import Ledger


def read_events(spark: SparkSession, path: str, schema: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON lines as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)


def commit_units(units: DataFrame, ledger: Ledger, work: Callable[[DataFrame], tuple[DataFrame, DataFrame]], checkpoint: str) -> StreamingQuery:
    """Runs work on the units of each micro-batch that aren't acknowledged and commits its (rows, acks) once, under the
    query's id and the batch's number: a batch that is run again after its commit changes nothing, and another query on
    the same ledger, or this one with a fresh checkpoint, has saves of its own."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows, acks = work(ledger.pending(batch))
        ledger.commit(rows, acks, source=f"{query}:{batch_id}")

    return units.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_arrivals(samples: DataFrame, *, text: str = "sample", ts: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first of each text to arrive; with an event time, state is kept only for `delay`."""
    keyed = samples.withColumn("sample_id", content_id(text))
    return keyed.dropDuplicates(["sample_id"]) if ts is None else keyed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["sample_id"])


def usage_windows(events: DataFrame, *, width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Calls, tokens and errors per model and tumbling window of `ts`; late events count within `delay`."""
    calls = events.where("ev = 'call'").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return calls.groupBy(F.window("ts", width), "model").agg(F.count(F.lit(1)).alias("calls"), F.sum("in_tok").alias("in_tok"), F.sum("out_tok").alias("out_tok"), F.count_if(F.col("error").isNotNull()).alias("errors"))


def sessions(events: DataFrame, key: str, *, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Events per key and session, a session ending after a gap without events."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy(F.session_window("ts", gap), key).agg(F.count(F.lit(1)).alias("events"))
