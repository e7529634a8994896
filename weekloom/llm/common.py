"""Tables the registered queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return source_table(spark, folder, "documents")
