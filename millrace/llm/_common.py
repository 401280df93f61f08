"""What the operators of this subpackage share: table reads, scratch tables, word and text rules."""

from __future__ import annotations

import gc
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words and is stripped from lines.
WHITE_SPACE = " \t\n\x0b\f\r"
#: A word, as most contracts take it.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOCAL_SCRATCH = "file:///tmp/checkpoints/millrace"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else: other alphabets keep their case."""
    return F.translate(text, UPPER, LOWER)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a local one only where it is unset and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return LOCAL_SCRATCH


def _path(spark: SparkSession, where: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends."""
    where = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    path, fs = _path(spark, where)
    fs.deleteOnExit(path)
    return where


def drop_scratch(spark: SparkSession, where: str) -> None:
    path, fs = _path(spark, where)
    fs.delete(path, True)


def release_memory(spark: SparkSession) -> None:
    """Lets Spark's cleaner see that finished stages are no longer referenced, so that their shuffle files go, and has
    the driver's JVM give back what it has freed outside its heap, of which a long chain of jobs leaves much. The
    command for that is one of the JVM's management interface; a JVM without it keeps the memory."""
    gc.collect()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    # the server's class isn't public, so its method is looked up by the interface
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        invoke.invoke(server, given)
    except Py4JJavaError:
        return


def materialise(df: DataFrame, label: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes df once as a table in the shared folder and reads it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    where = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(where)
    back = spark.read.schema(df.schema).parquet(where)
    release_memory(spark)
    return back
