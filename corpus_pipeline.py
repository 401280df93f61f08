"""The corpus pipeline: STAGES applied to `documents`, each stage written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of `documents`: doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, line_dedup, mixing, near_dedup, quality
from millrace.llm._common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones of docs, predicts to be of quality stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents repeat stay in one of them; n_chars follows the text. Documents all stay."""
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS))
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")
    return cut.select("doc_id", "text", "lang", "source", chars)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity of 0.8 or more.

    Rows that repeat a doc_id are one document and stay or go together.
    """
    found = near_dedup.near_duplicates(docs, width=5, percent=80)
    gone = materialise(found.where("NOT kept").select("doc_id").distinct(), "pipeline-gone")
    side = F.broadcast(gone) if gone.count() <= near_dedup.BROADCAST_SETS else gone
    return docs.join(side, "doc_id", "left_anti").select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document that is left."""
    return mixing.mix(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("repeated_lines", repeated_lines),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mix_sources", mix_sources),
]

#: The first stage is a trained model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
