"""Index panels from transaction tables.

Lines are joined to their dimension and summed to one row per dimension key and week before any
window runs; names are attached to the sums. Only the line table and its key-equal partner are
shuffled, with three and two narrow columns, and adaptive execution splits a hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import week_ending

TOTAL = "TOTAL"
BASELINE_YEAR = 1996

# Columns the panels read. A declared schema spares the job that opens files to infer one.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_type string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _weekly(joined: DataFrame, key: str) -> DataFrame:
    return joined.groupBy(key, "week_ending").agg(F.sum("l_quantity").alias("qty"))


def _lines(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        key, "l_quantity", week_ending("l_shipdate").alias("week_ending")
    )


def region_weekly(spark: SparkSession, folder: str, only: str | None = None) -> DataFrame:
    """Quantity per nation and week; with ``only``, for one nation, whose customers and orders are
    selected before the lines are joined."""
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("series"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    at_home = F.col("c_nationkey") == F.col("n_nationkey")
    if only is not None:
        nation = nation.where(F.col("series") == only)
        customer = customer.join(nation.select("n_nationkey"), at_home, "left_semi")
    owner = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    lines = _lines(spark, folder, "l_orderkey").join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
    return _weekly(lines, "c_nationkey").join(nation, at_home).select("series", "week_ending", "qty")


def site_weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity per part type and week."""
    part = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("series"))
    lines = _lines(spark, folder, "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return _weekly(lines, "series")


#: Order of the lines; it tells them apart.
LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")


def line_series(spark: SparkSession, folder: str) -> DataFrame:
    """All lines as one series of single values, whose length is the table's: ``series, week_ending, idx`` and the
    columns of ``LINE_ORDER``. Lines without a discount count as not measured."""
    return table(spark, folder, "lineitem").select(
        F.lit("LINES").alias("series"), week_ending("l_shipdate").alias("week_ending"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("idx"), *LINE_ORDER,
    )


def with_total(weekly: DataFrame, total: str = TOTAL) -> DataFrame:
    """Add the all-series total as one more series, from the weekly rows, not from the lines. A series that
    already has the total's name stops the job; choose another ``total`` then."""
    own = F.when(
        F.col("series") == total, F.raise_error(F.lit(f"a series is called {total}; name the total otherwise"))
    ).otherwise(F.col("series"))
    return (
        weekly.select(
            F.explode(F.array(own, F.lit(total))).alias("series"), "week_ending", "qty"
        )
        .groupBy("series", "week_ending")
        .agg(F.sum("qty").alias("qty"))
    )


def to_index(weekly: DataFrame, baseline_year: int = BASELINE_YEAR) -> DataFrame:
    """``idx`` = quantity as a percentage of the series' mean week in the baseline year; null for a series
    whose base is missing or zero."""
    base = F.avg(F.when(F.year("week_ending") == baseline_year, F.col("qty"))).over(Window.partitionBy("series"))
    return weekly.withColumn("idx", F.lit(100.0) * F.col("qty") / F.nullif(base, F.lit(0.0)))


def region_panel(
    spark: SparkSession, folder: str, total: bool = True, only: str | None = None
) -> DataFrame:
    """Panel ``series, week_ending, qty, idx`` by nation, with the total series unless told not to."""
    weekly = region_weekly(spark, folder, only)
    return to_index(with_total(weekly) if total and only is None else weekly)


def site_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Panel ``series, week_ending, qty, idx`` by part type."""
    return to_index(site_weekly(spark, folder))


def _seen_week(panel: DataFrame) -> Column:
    """The week of a row with a quantity (a value, in stored panels). Looking at the quantity keeps the
    plan of a subquery equal to the panel's, so the exchange is shared and the lines are read once."""
    seen = "qty" if "qty" in panel.columns else "idx"
    return F.when(F.col(seen).isNotNull(), F.col("week_ending"))


def latest_week(panel: DataFrame) -> Column:
    """Newest week of a panel as a scalar subquery."""
    return panel.agg(F.max(_seen_week(panel))).scalar()


def week_bounds(panel: DataFrame) -> Column:
    """First and last week of a panel as one scalar struct."""
    week = _seen_week(panel)
    return panel.agg(F.struct(F.min(week).alias("lo"), F.max(week).alias("hi"))).scalar()
