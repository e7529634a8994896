"""Display labels for series keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Labels of the tidy export and of the statistical reports.
REGION_LABELS = {
    "UK_total": "UK Total",
    "England": "England",
    "Northern_Ireland": "Northern Ireland",
    "Scotland": "Scotland",
    "Wales": "Wales",
    "East_of_England": "East of England",
    "East_Midlands": "East Midlands",
    "London": "London",
    "North_East": "North East",
    "North_West": "North West",
    "South_East": "South East",
    "South_West": "South West",
    "West_Midlands": "West Midlands",
    "Yorkshire_and_The_Humber": "Yorkshire & The Humber",
}
SITE_LABELS = {
    "District_and_Local_Centres": "District & Local Centres",
    "Retail_Parks": "Retail Parks",
    "Town_and_City_Centres": "Town & City Centres",
}


def dim_series(spark: SparkSession, labels: dict[str, str]) -> DataFrame:
    """Label dimension ``series, label`` from a dictionary."""
    return spark.createDataFrame(list(labels.items()), "series string, label string")


def labels(df: DataFrame, dim: DataFrame, key: str = "series") -> DataFrame:
    """Add ``label`` (null where unknown) and ``label_or_key`` (the key where unknown)."""
    named = dim.select(F.col("series").alias("_k"), F.col("label"))
    return (
        df.join(named, F.col(key) == F.col("_k"), "left")
        .drop("_k")
        .withColumn("label_or_key", F.coalesce("label", key))
    )
