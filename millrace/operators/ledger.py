"""Commit and resume: rows first, then acknowledgements, each save a numbered part of one table.

A ledger is a Parquet table (save, key columns, status) whose saves count once their number is in the commits table;
a save that was cut off is not in it, and its rows are ignored. Nothing that counts is ever overwritten: taking units
out adds one save, whose commit says up to which number the saves before it stop counting. That is one new file, so a
writer that dies at any point leaves either the old state or the new one. A lock file lets one writer in at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMIT = "n_rows bigint, n_acks bigint, retires bigint, source string, save bigint"


class Locked(RuntimeError):
    """Another writer has the ledger."""


class Ledger:
    """The finished units of a stage below `path`, keyed by columns given as DDL."""

    def __init__(self, spark: SparkSession, path: str, keys: str = "sample_id string, iteration int"):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.names = [k.split()[0] for k in keys.split(",")]

    # -- reading -------------------------------------------------------------------------------------------------------

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def every_commit(self) -> DataFrame:
        """All commits that were made, retired ones too."""
        return self._read("commits", _COMMIT)

    def commits(self) -> DataFrame:
        """(save, n_rows, n_acks, source) of the saves that count."""
        every = self.every_commit()
        retired = every.agg(F.max("retires")).first()[0] or 0
        return every.where(F.col("save") > retired).select("save", "n_rows", "n_acks", "source")

    def acks(self) -> DataFrame:
        """The acknowledgements of finished saves: keys and status."""
        return self._counted("acks", f"{self.keys}, status string").select(*self.names, "status")

    def rows(self, schema: str) -> DataFrame:
        """The rows of finished saves."""
        return self._counted("rows", schema).drop("save")

    def _counted(self, name: str, schema: str) -> DataFrame:
        return self._read(name, f"{schema}, save bigint").join(F.broadcast(self.commits().select("save")), "save", "left_semi")

    def pending(self, plan: DataFrame) -> DataFrame:
        """The planned units that aren't acknowledged."""
        return plan.join(self.acks().select(*self.names), self.names, "left_anti")

    def torn(self) -> DataFrame:
        """(save, part, wanted, found) of finished saves whose stored rows or acks are not as many as their commit says."""
        live, out = self.commits(), []
        for part, wanted in (("rows", "n_rows"), ("acks", "n_acks")):
            found = self._read(part, "save bigint").groupBy("save").agg(F.count(F.lit(1)).alias("found"))
            both = live.join(found, "save", "left").select("save", F.lit(part).alias("part"), F.col(wanted).alias("wanted"), F.coalesce("found", F.lit(0)).alias("found"))
            out.append(both.where("wanted <> found"))
        return out[0].unionAll(out[1])

    # -- writing -------------------------------------------------------------------------------------------------------

    def _file(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    @contextmanager
    def _alone(self) -> Iterator[None]:
        path, fs = self._file("_lock")
        try:
            fs.create(path, False).close()
        except Py4JJavaError as error:
            if "AlreadyExists" not in str(error.java_exception.getClass().getName()) and "exists" not in str(error.java_exception.getMessage()):
                raise
            raise Locked(f"{self.path} has a writer; if it is dead, call release_lock()") from error
        try:
            yield
        finally:
            fs.delete(path, False)

    def release_lock(self) -> bool:
        """Takes away the lock of a writer that has died. Whether there was one."""
        path, fs = self._file("_lock")
        return fs.delete(path, False)

    def _write(self, rows: DataFrame, name: str, save: int) -> None:
        rows.withColumn("save", F.lit(save).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("save").parquet(f"{self.path}/{name}")

    def _size(self, name: str, save: int) -> int:
        return self._read(name, "save bigint").where(F.col("save") == save).count()

    def next_save(self) -> int:
        return (self.every_commit().agg(F.max("save")).first()[0] or 0) + 1

    def _finish(self, rows: DataFrame, acks: DataFrame, source: str | None, retires: int) -> int:
        """Rows, then acks, then the commit, under a number that no commit has. What a writer that died left under that
        number is replaced. Counts are those of what was written: a plan is evaluated once."""
        save = self.next_save()
        self._write(rows, "rows", save)
        self._write(acks.select(*self.names, F.col("status").cast("string")), "acks", save)
        self._write(self.spark.createDataFrame([(self._size("rows", save), self._size("acks", save), retires, source)], _COMMIT.rpartition(",")[0]), "commits", save)
        return save

    def commit(self, rows: DataFrame, acks: DataFrame, source: str | None = None) -> int:
        """Adds a save of rows and acks (keys and status) and returns its number. A source names where it comes from: what
        one has committed is not committed again, and the number is that of the first time."""
        with self._alone():
            if source is not None and (done := self.every_commit().where(F.col("source") == source).select("save").first()):
                return done[0]
            return self._finish(rows, acks, source, 0)

    def drop(self, doomed: DataFrame, schema: str) -> int:
        """Takes out the units of `doomed` (keys), rows and acks alike: what is left becomes one new save, and its commit
        retires all before it."""
        left = lambda x: x.join(doomed.select(*self.names).distinct(), self.names, "left_anti")
        with self._alone():
            return self._finish(left(self.rows(schema)), left(self.acks()), None, self.next_save() - 1)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A manifest or ledger as JSON lines; lines that aren't objects of the schema are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def finished_lines(lines: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """Of ledger lines with a `saved` column: the keys up to the last line that has it; all where none has."""
    last = lines.where("saved IS NOT NULL").agg(F.max(order)).first()[0]
    return (lines if last is None else lines.where(F.col(order) <= F.lit(last))).select(*keys).distinct()
