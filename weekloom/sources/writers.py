"""Sinks: report tables, panel layout, JSON documents and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .scratch import stored


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a result table (``parquet``, ``orc``, ``json`` or ``csv`` with header)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def save_panel(
    df: DataFrame, path: str, mode: str = "errorifexists", counted: tuple[Observation, Sequence[Column]] | None = None,
    drop: Sequence[str] = (),
) -> None:
    """Write a panel for repeated reading: a folder per year, rows ranged and sorted by series and
    week, so that year filters prune folders and series filters skip Parquet row groups.

    ``counted`` observes metrics of the rows as they are written, in the last stage, where a task that runs again
    is not counted twice; ``drop`` names columns that only the metrics need."""
    out = df if "year" in df.columns else df.withColumn("year", F.year("week_ending"))
    out = out.repartitionByRange("year", "series", "week_ending").sortWithinPartitions("year", "series", "week_ending")
    if counted:
        out = out.observe(counted[0], *counted[1])
    out.drop(*drop).write.mode(mode).partitionBy("year").parquet(path)


def save_bucketed(df: DataFrame, path: str, table: str, buckets: int | None = None, key: str = "series") -> DataFrame:
    """Write a panel as an external table in buckets of series, a file each, sorted by series and week, and read it
    back through the catalog. Windows and aggregates per series, and joins of panels with as many buckets on the
    series, then need no exchange. The buckets follow the shuffle partitions unless given."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    (
        df.repartition(n, key).sortWithinPartitions(key, "week_ending")
        .write.bucketBy(n, key).sortBy(key, "week_ending").option("path", path).format("parquet").saveAsTable(table)
    )
    return spark.table(table)


def save_lines(df: DataFrame, path: str, order: str = "ord", mode: str = "errorifexists") -> None:
    """Write a ``line`` column as text in ``order``; part files follow the order."""
    df.orderBy(order).select("line").write.mode(mode).text(path)


def save_log(log: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Write the validation log as text, only when there are issues. The log is computed once."""
    log = stored(log, "log")
    if log.isEmpty():
        return False
    lines = log.select(
        F.struct("check", "series", "detail").alias("ord"),
        F.format_string("%s | %s | %s | %d", "check", "series", "detail", "n").alias("line"),
    )
    save_lines(lines, path, mode=mode)
    return True
