"""Line dedup with levelled sorted runs of line hashes.

A run is a table (h1, h2, n_docs, keeper), sorted by the 128-bit hash of a line's key: in how many documents the line
was found and the largest doc_id of them. Documents come in batches of descending doc_id. A batch first counts its own
lines, then merge-anti-joins the runs: a line that some run already holds as `min_docs` times found needs no more
counting, as neither verdict nor keeper can change. The rest becomes a new run of level 0; as soon as a level has
`fan_out` runs they are compacted into one of the next level. After the last batch, all runs merged give the frequent
lines, and documents drop those that they don't keep.

Counts are combined before they are shuffled, by (line, document) and then by line, so a line that a third of all
documents hold is a row per task. Runs are files in the shared folder; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import LOWER, UPPER, WHITE_SPACE, ascii_lower, materialise, table

_LEAST = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(WHITE_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _h1(key: Column) -> Column:
    return F.xxhash64(key)


def _h2(key: Column) -> Column:
    return F.xxhash64(F.lit("second"), key)


class LineRuns:
    """The levelled store. Batches must be added in descending order of their doc_ids."""

    def __init__(self, spark: SparkSession, *, min_docs: int, fan_out: int = 2):
        self.spark, self.min_docs, self.fan_out = spark, min_docs, fan_out
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, counted: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(materialise(counted.sortWithinPartitions("h1", "h2"), f"lines-level{level}"))

    def add(self, postings: DataFrame) -> None:
        """postings: (h1, h2, id), repeated rows allowed."""
        fresh = postings.groupBy("h1", "h2", "id").agg(F.lit(1).alias("_")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        for run in self.runs():
            settled = run.where(F.col("n_docs") >= self.min_docs).select("h1", "h2")
            fresh = fresh.join(settled.hint("merge"), ["h1", "h2"], "left_anti")
        self._write(fresh, 0)
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            merged, self.levels[level] = self._merged(self.levels[level]), []
            self._write(merged, level + 1)
            level += 1

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionAll, runs).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def frequent(self) -> DataFrame:
        """(h1, h2, keeper) of the lines found in at least min_docs documents."""
        return materialise(self._merged(self.runs()).where(F.col("n_docs") >= self.min_docs).drop("n_docs"), "lines-frequent")


def dedup_lines(docs: DataFrame, *, min_docs: int = 5, min_chars: int = 40, batches: int = 4, fan_out: int = 2) -> DataFrame:
    """Returns docs with the repeated lines taken out of `text`, and the columns n_lines and n_dropped.

    A line whose key has at least min_chars code points and is found in at least min_docs documents (distinct doc_ids)
    stays in the document of the largest doc_id only, as often as it stands there. A null or empty text is one empty
    line. A null doc_id counts as one document below all others. Repeated rows of a doc_id are one document when
    counting and keep their rows. Other columns pass through; columns named n_lines or n_dropped are replaced. An empty
    table stays empty. Batches are cut at approximate quantiles of the doc_ids, so any 64-bit ids will do.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    ident = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST))
    cuts = docs.agg(F.percentile_approx(ident, [k / batches for k in range(1, batches)], 1000)).first()[0] if batches > 1 else None
    # how many cuts lie above: batch 0 has the largest ids
    batch = reduce(Column.__add__, [(ident <= F.lit(cut)).cast("int") for cut in cuts or ()], F.lit(0))
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), line_key), lambda k: F.length(k) >= min_chars))
    postings = materialise(
        docs.select(ident.alias("id"), batch.alias("batch"), F.explode(keys).alias("key")).select(_h1(F.col("key")).alias("h1"), _h2(F.col("key")).alias("h2"), "id", "batch"),
        "lines-postings",
        partition_by=("batch",),
    )
    store = LineRuns(spark, min_docs=min_docs, fan_out=fan_out)
    for k in range(batches):
        store.add(postings.where(F.col("batch") == k).drop("batch"))
    drops = postings.join(store.frequent(), ["h1", "h2"]).where("id <> keeper").groupBy("id").agg(F.collect_set(F.struct("h1", "h2")).alias("drops"))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), ident.alias("id"))
    lines = _lines(F.col("row.text"))

    def stays(line: Column) -> Column:
        key = line_key(line)
        return ~((F.length(key) >= min_chars) & F.array_contains(F.col("drops"), F.struct(_h1(key).alias("h1"), _h2(key).alias("h2"))))

    cut = (
        inner.join(drops, "id", "left")
        .withColumn("n_lines", F.size(lines).cast("bigint"))
        .withColumn("kept", F.when(F.col("drops").isNotNull(), F.filter(lines, stays)))
        .withColumn("n_dropped", F.when(F.col("kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("bigint"))
    )
    text = F.when(F.col("n_dropped") > 0, F.array_join("kept", "\n")).otherwise(F.col("row.text")).alias("text")
    return cut.select(*[text if c == "text" else F.col("row")[c].alias(c) for c in columns], "n_lines", "n_dropped")


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_SPACES = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(doc_id, {_LEAST}) AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_SPACES}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, max(id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT id) >= 5),
m AS (SELECT k.rid, k.line, k.pos, (f.key IS NOT NULL AND k.id <> f.keeper) AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT d.doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT m.dropped), '')) AS kept_sha256
FROM m JOIN d USING (rid) GROUP BY d.rid, d.doc_id"""
