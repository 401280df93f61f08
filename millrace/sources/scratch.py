"""Folders for tables that a query writes on its way."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

LOCAL = "file:///tmp/checkpoints/millrace"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors share; a local one only where that is unset and the
    master is local. It goes when the session's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = f"{(root or LOCAL).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where
