"""Intermediate tables in the folder that driver and executors share.

The folder is ``spark.checkpoint.dir``. Where the session has none, a temporary folder is made, but only
for a session that runs inside one process (``local[...]``); on a cluster that is an error, because each
executor would write to its own disk. Spark deletes the tables when the session's JVM ends.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="weekloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{scratch_folder(spark)}/weekloom/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lineage cut that outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
