"""Artifacts of a run as tables: CSV with a fixed header, category trees, taxonomies, seeds, hub exports, records.

Spark reads and writes everything, so paths may lie in any store; nothing is opened on the driver.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import cell_text, missing_to_null

# left to itself Spark's writer cuts blanks and control characters off both ends of a cell, and its reader takes the NUL
# characters of a quoted cell for escapes
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "charToEscapeQuoteEscaping": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: Columns of a sample, in order.
SAMPLE_COLUMNS = ("sample_id", "sample", "category", "subcategory", "entry_type", "turn", "accepted", "rejection_reason", "source")
#: The artifacts' schemas, all text but what is named with a type.
SCHEMAS = {
    "constitution": "sample_id string, constitution_category string, constitution_subcategory string, sample_description string, entry_type string, source_category string, source_group_tag string, model string",
    "samples": "sample_id string, sample string, category string, subcategory string, entry_type string, turn int, accepted string, rejection_reason string, source string",
    "outputs": "input_id string, input_prompt string, category string, subcategory string, entry_type string, model string, source string, sample_id string, output_response string, accepted string, rejection_reason string",
    "paraphrases": "sample_id string, input_id string, iteration int, sample string, category string, entry_type string, paraphrase_model string, accepted string, reasoning string, source string",
    "augmented": "sample_id string, input_id string, sample string, category string, entry_type string, jailbreak string, technique string, technique_info string, complexity int, num_techniques int, is_noop boolean, accepted string, reasoning string, iteration int, combination_spec_version string",
    "conversations": "sample_id string, input_id string, iteration int, setting string, turns_used int, stop_reason string, transcript string, category string, entry_type string, source string",
    "scored": "sample_id string, success boolean, judge_reasoning string, judge_model string, scope string",
    "manifest": "sample_id string, iteration int, combination array<string>, settings map<string,string>, category string, entry_type string, status string",
}


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_rows(spark: SparkSession, path: str, schema: str | T.StructType | None = None, *, columns: list[str] | None = None, na_to_null: bool = False, text_cells: bool = False) -> DataFrame:
    """A CSV artifact; all columns are text without a schema. A missing path is an empty table of the schema. With
    na_to_null the cells of MISSING_CELLS become null; with text_cells those that text_cell made are texts again. Columns
    are pruned by the scan."""
    try:
        rows = (spark.read.schema(schema) if schema is not None else spark.read).csv(path, **_CSV)
        rows = rows.withColumnRenamed(rows.columns[0], rows.columns[0].lstrip("﻿")) if rows.columns else rows
    except AnalysisException as error:
        if not _missing(error):
            raise
        rows = spark.createDataFrame([], schema if schema is not None else T.StructType([]))
    if columns is not None:
        rows = rows.select(*columns)
    if na_to_null:
        rows = rows.select(*[missing_to_null(c).alias(c) if kind == "string" else F.col(c) for c, kind in rows.dtypes])
    if text_cells:
        rows = rows.select(*[cell_text(c).alias(c) if kind == "string" else F.col(c) for c, kind in rows.dtypes])
    return rows


def check_columns(rows: DataFrame, header: list[str]) -> None:
    """Raises if rows has a column that the artifact's header lacks; missing ones are written empty."""
    if extra := [c for c in rows.columns if c not in header]:
        raise ValueError(f"columns not in the artifact: {', '.join(extra)}")


def append_rows(rows: DataFrame, path: str, schema: str) -> None:
    """Appends rows in the artifact's column order. The committer makes the append all or nothing."""
    wanted = T.StructType.fromDDL(schema)
    check_columns(rows, wanted.fieldNames())
    rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]).write.mode("append").csv(path, **{k: v for k, v in _CSV.items() if k != "multiLine"})


def keys_in(rows: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Distinct keys, each cast to its type; without one of the columns there are none."""
    if any(c not in rows.columns for c in casts):
        return rows.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in casts.items()))
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in casts.items()]).distinct()


def _named(category: str) -> str:
    if not category or re.search(r"[/\\]", category):
        raise ValueError(f"not a category name: {category!r}")
    return category


def write_tree(rows: DataFrame, path: str) -> None:
    """Overwrites the categories that rows holds and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("category").parquet(path)


def read_tree(spark: SparkSession, path: str, schema: str, categories: list[str] | None = None, *, accepted_only: bool = False) -> DataFrame:
    """The samples of these categories, or of all; only their folders are read. A missing tree is empty."""
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        rows = spark.createDataFrame([], schema)
    if categories is not None:
        rows = rows.where(F.col("category").isin([_named(c) for c in categories]))
    return rows.where(F.lower(F.col("accepted").cast("string")) == "true") if accepted_only else rows


def discover_categories(spark: SparkSession, path: str, schema: str) -> list[str]:
    """The categories that have rows, sorted: a taxonomy's worth of names."""
    return [r[0] for r in read_tree(spark, path, schema).select("category").distinct().orderBy("category").collect()]


def read_inputs(spark: SparkSession, seeded: str, plain: str, schema: str) -> DataFrame:
    """The accepted samples of a run's input tree: the seeded one if it has any rows, else the plain one."""
    tree = plain if read_tree(spark, seeded, schema).isEmpty() else seeded
    return read_tree(spark, tree, schema, accepted_only=True)


def load_filtered(spark: SparkSession, path: str, *, fmt: str = "parquet", filters: dict[str, list] | None = None, excludes: dict[str, list] | None = None, columns: list[str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """A hub's export: rows whose columns are among `filters` and not among `excludes`, then the columns."""
    rows = spark.read.format(fmt).option("header", True).load(path)
    for name, values in (filters or {}).items():
        rows = rows.where(F.col(name).isin(values))
    for name, values in (excludes or {}).items():
        rows = rows.where(~F.coalesce(F.col(name).isin(values), F.lit(False)))
    rows = rows.drop(*drop)
    return rows.select(*columns) if columns is not None else rows


TAXONOMY = "name string, description string, aliases map<string,string>, groups map<string,array<string>>, categories map<string,struct<description:string,subcategories:array<string>,group_tag:string>>"


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(pos, category, description, subcategories, group_tag) of a taxonomy document, in its order."""
    rows = spark.read.schema(TAXONOMY).json(path, multiLine=True)
    return rows.select(F.posexplode("categories").alias("pos", "category", "info")).select("pos", "category", "info.*")


def first_categories(taxonomy: DataFrame, n: int | None) -> DataFrame:
    """The first n categories of a taxonomy in its order, or all; a feature, not a sample."""
    ordered = taxonomy.orderBy("pos")
    return ordered if n is None else ordered.limit(n)


def taxonomy_document(name: str, categories: dict[str, str | dict], *, description: str = "", aliases: dict[str, str] | None = None, groups: dict[str, list[str]] | None = None) -> str:
    """The document's JSON; a bare string is a description."""
    full = {k: {"description": v} if isinstance(v, str) else v for k, v in categories.items()}
    return json.dumps({"name": name, "description": description, "categories": {k: {"subcategories": [], "group_tag": None, **v} for k, v in full.items()}, "aliases": aliases or {}, "groups": groups or {}}, ensure_ascii=False)


def write_document(spark: SparkSession, text: str, path: str) -> None:
    """One text, as one file in the folder `path`."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def sub_category_pairs(taxonomy: DataFrame) -> DataFrame:
    """(main, sub) in order; a category without subcategories is its own."""
    subs = F.when(F.size("subcategories") > 0, F.col("subcategories")).otherwise(F.array("category"))
    pairs = taxonomy.select("pos", F.col("category").alias("main"), F.posexplode(subs).alias("sub_pos", "sub"))
    return pairs.groupBy("main", "sub").agg(F.min(F.struct("pos", "sub_pos")).alias("_at")).orderBy("_at").drop("_at")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """(category, pos, seed) of a document of lists by category."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return rows.select(F.explode("m").alias("category", "seeds")).select("category", F.posexplode("seeds").alias("pos", "seed"))


def resolve_overlay(defaults: DataFrame, overrides: DataFrame, keys: tuple[str, ...] = ("pipeline", "category")) -> DataFrame:
    """The override's `body` where there is one, else the default's, and which of them it is; overrides that match
    nothing come with origin `unmatched`."""
    both = defaults.select(*keys, F.col("body").alias("_d")).join(overrides.select(*keys, F.col("body").alias("_o")), list(keys), "full")
    origin = F.when(F.col("_d").isNull(), "unmatched").when(F.col("_o").isNull(), "default").otherwise("override")
    return both.select(*keys, F.coalesce("_o", "_d").alias("body"), origin.alias("origin"))


def append_record(spark: SparkSession, path: str, *, stage: str, timestamp: str, params: dict, models: dict, counts: dict) -> None:
    """A run record as a row of the records table."""
    row = (stage, timestamp, *(json.dumps(x, sort_keys=True) for x in (params, models, counts)))
    spark.createDataFrame([row], "stage string, timestamp string, params string, models string, counts string").write.mode("append").parquet(path)


def last_record(spark: SparkSession, path: str, stage: str) -> dict | None:
    """The latest record of a stage."""
    try:
        found = spark.read.parquet(path).where(F.col("stage") == stage).orderBy(F.desc("timestamp")).limit(1).collect()
    except AnalysisException as error:
        if not _missing(error):
            raise
        return None
    return {k: json.loads(v) if k in ("params", "models", "counts") else v for k, v in found[0].asDict().items()} if found else None
