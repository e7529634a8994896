"""A raw long feed with known faults, derived from a panel, for the quality and cleaning steps.

By position in the series: every 7th week is an Excel serial, every 29th is written as yyyyMMdd, every 97th
is a number that is no date, every 101st date is unreadable, every 11th value is text, every 17th value is missing, and every 13th row comes twice, the
second time later and one point higher."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import by_week

SERIAL_ORIGIN = "1899-12-30"


def _decimal_text(cents):
    whole = (cents / 100).cast("bigint").cast("string")
    return F.concat(whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def raw_feed(panel: DataFrame) -> DataFrame:
    """``series, week_raw, value_raw, ingest_seq`` as strings plus the arrival order."""
    pos = F.col("pos")
    rows = panel.select(
        "series",
        "week_ending",
        F.rint(F.col("idx") * 100).cast("bigint").alias("cents"),
        F.row_number().over(by_week()).cast("bigint").alias("pos"),
    )
    copies = F.when(pos % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    serial = F.datediff("week_ending", F.lit(SERIAL_ORIGIN).cast("date")).cast("string")
    iso = F.date_format("week_ending", "yyyy-MM-dd")
    return rows.withColumn("copy", F.explode(copies)).select(
        "series",
        F.when(pos % 101 == 0, F.lit("unknown"))
        .when(pos % 97 == 0, F.lit("99999999"))
        .when(pos % 29 == 0, F.date_format("week_ending", "yyyyMMdd"))
        .when(pos % 7 == 0, serial)
        .otherwise(iso)
        .alias("week_raw"),
        F.when(pos % 17 == 0, F.lit(None).cast("string"))
        .when(pos % 11 == 0, F.lit("n/a"))
        .otherwise(_decimal_text(F.col("cents") + F.col("copy") * 100))
        .alias("value_raw"),
        (pos * 2 + F.col("copy")).alias("ingest_seq"),
    )
