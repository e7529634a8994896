"""Readers: format by suffix, wide and long panels, optional second input."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGEST_ORDER = ("ingest_file", "ingest_block", "ingest_row")
FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".orc": "orc"}

LONG_SCHEMA = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("week_ending", T.DateType()),
        T.StructField("idx", T.DoubleType()),
    ]
)


def source_format(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported file format: {suffix or path}")
    return FORMATS[suffix]


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table with the format its suffix names; other suffixes raise ``ValueError``.

    CSV columns stay strings unless a schema is given: typing is the cleaning step's work, and
    inference would read the files twice."""
    fmt = source_format(path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """Raw wide panel: all columns as strings, plus columns that keep the file order.

    The order is (file, split offset, row counter): within one split rows are numbered as they
    are read, so it does not depend on how splits are packed into tasks."""
    raw = read_any(spark, path)
    names = raw.columns
    return raw.select(
        *[F.col(c).cast("string").alias(c) for c in names],
        F.col("_metadata.file_path").alias("ingest_file"),
        F.col("_metadata.file_block_start").alias("ingest_block"),
        F.monotonically_increasing_id().alias("ingest_row"),
    )


def read_panel(spark: SparkSession, path: str) -> DataFrame | None:
    """Long panel ``series, week_ending, idx``, or None when the path does not exist."""
    try:
        df = read_any(spark, path, LONG_SCHEMA if source_format(path) == "csv" else None)
        return df.select("series", F.col("week_ending").cast("date").alias("week_ending"), "idx")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def read_pair(
    spark: SparkSession, region_path: str, site_path: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Two related raw panels; the site panel is optional."""
    return read_wide(spark, region_path), read_wide(spark, site_path) if site_path else None


def load_stats(df: DataFrame) -> DataFrame:
    """Row and column count of an input."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint")
    )
