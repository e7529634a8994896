"""Validation checks over a raw feed (strings, in arrival order) and its log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import by_week, rnd
from .clean import clean_feed, is_serial, to_number, typed, with_weeks

INDEX_MIN, INDEX_MAX = 50.0, 200.0
SLACK_DAYS = 9


def null_pct(raw: DataFrame) -> DataFrame:
    """Share of missing raw values per series, in percent."""
    missing = F.avg(F.col("value_raw").isNull().cast("double")) * 100
    return raw.groupBy("series").agg(rnd(missing, 4).alias("pct_null"))


def range_check(raw: DataFrame, lo: float = INDEX_MIN, hi: float = INDEX_MAX) -> DataFrame:
    """Numeric values outside [lo, hi] per series; nulls do not count."""
    v = to_number("value_raw")
    return raw.groupBy("series").agg(F.count_if((v < lo) | (v > hi)).alias("n_out"))


def date_gaps(raw: DataFrame, slack_days: int = SLACK_DAYS) -> DataFrame:
    """Gaps of more than ``slack_days`` between neighbouring weeks, with the whole weeks missing. A gap that
    holds no whole week (10 to 13 days) is ``irregular``: a week was moved, not lost.
    Copies are dropped first, which bounds the window by the calendar."""
    weeks = (
        with_weeks(raw).select("series", "week_ending")
        .where(F.col("week_ending").isNotNull())
        .distinct()
    )
    days = F.datediff("to_week", "from_week")
    return (
        weeks.select(
            "series",
            F.lag("week_ending").over(by_week()).alias("from_week"),
            F.col("week_ending").alias("to_week"),
        )
        .where(days > slack_days)
        .withColumn("missing", (F.floor(days / 7) - 1).cast("bigint"))
        .withColumn("irregular", F.col("missing") == 0)
    )


def duplicates(raw: DataFrame) -> DataFrame:
    """Rows beyond the first per series and parsed week."""
    keys = with_weeks(raw).select("series", "week_ending").where(F.col("week_ending").isNotNull())
    per_key = keys.groupBy("series", "week_ending").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("series").agg(F.sum(F.col("n") - 1).cast("bigint").alias("n_dup"))


def type_check(raw: DataFrame) -> DataFrame:
    """Values that are present but no number, per series."""
    bad = F.col("value_raw").isNotNull() & to_number("value_raw").isNull()
    return raw.groupBy("series").agg(F.count_if(bad).alias("n_bad"))


def serial_dates(raw: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of Excel-serial week values per series; above ``share`` the column is a serial column."""
    part = F.avg(is_serial("week_raw").cast("double"))
    return raw.groupBy("series").agg(
        F.count_if(is_serial("week_raw")).alias("n_serial"),
        rnd(part, 6).alias("share_serial"),
        (part > share).alias("is_serial_column"),
    )


def bad_dates(raw: DataFrame) -> DataFrame:
    """Rows whose week cannot be read; cleaning sets them aside."""
    bad = F.count_if(F.col("week_ending").isNull())
    return with_weeks(raw).groupBy("series").agg(bad.alias("n_bad_date"))


# Checks of the log with their texts, in the order they are reported.
LOG_CHECKS = {
    "null": "missing values",
    "range": "values outside [50, 200]",
    "type": "values that are no number",
    "serial_date": "weeks given as serials",
    "bad_date": "weeks set aside",
    "duplicate": "repeated weeks",
}


def dq_log(raw: DataFrame, slack_days: int = SLACK_DAYS) -> DataFrame:
    """All issues as ``check, series, detail, n``, zero counts left out.

    The feed is counted once per series and week; series totals and week gaps both come from those
    counts in the same pass."""
    t = typed(raw)
    v, text, week = F.col("value"), F.col("value_raw"), F.col("week_ending")
    per_week = t.groupBy("series", "week_ending").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(text.isNull()).alias("null"),
        F.count_if((v < INDEX_MIN) | (v > INDEX_MAX)).alias("range"),
        F.count_if(text.isNotNull() & v.isNull()).alias("type"),
        F.count_if(is_serial("week_raw")).alias("serial_date"),
    )
    per_week = per_week.withColumns(
        {
            "bad_date": F.when(week.isNull(), F.col("n")).otherwise(0),
            "duplicate": F.when(week.isNotNull(), F.col("n") - 1).otherwise(0),
            "_from": F.lag("week_ending").over(by_week()),
        }
    )
    days = F.datediff("week_ending", "_from")
    iso = "yyyy-MM-dd"
    gap = F.struct(
        F.lit("gap").alias("check"),
        F.concat_ws(" to ", F.date_format("_from", iso), F.date_format("week_ending", iso)).alias("detail"),
        (F.floor(days / 7) - 1).cast("bigint").alias("n"),
    )
    per_series = per_week.groupBy("series").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in LOG_CHECKS],
        F.collect_list(F.when(days > slack_days, gap)).alias("gaps"),
    )
    counts = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.lit(d).alias("detail"), F.col(c).alias("n"))
            for c, d in LOG_CHECKS.items()
        ]
    )
    issues = F.concat(F.filter(counts, lambda r: r.n > 0), F.col("gaps"))
    return per_series.select("series", F.explode(issues).alias("r")).select(
        "r.check", "series", "r.detail", "r.n"
    )


def etl_stats(raw: DataFrame, fill_weeks: bool = True) -> DataFrame:
    """Counters of one run: rows in and out, values filled, values flagged, copies removed."""
    t = typed(raw)
    v, week = F.col("value"), F.col("week_ending")
    per_key = t.groupBy("series", "week_ending").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((v < INDEX_MIN) | (v > INDEX_MAX)).alias("out"),
    )
    dup = F.when(week.isNotNull(), F.col("n") - 1).otherwise(0)
    intake = per_key.agg(
        F.sum("n").cast("bigint").alias("rows_raw"),
        F.sum("out").cast("bigint").alias("anomalies_flagged"),
        F.sum(dup).cast("bigint").alias("duplicates_removed"),
    )
    filled = F.count_if(F.col("value").isNull() & F.col("value_filled").isNotNull())
    done = clean_feed(t, fill_weeks).agg(
        F.struct(F.count(F.lit(1)).alias("rows_final"), filled.alias("nulls_filled"))
    )
    return intake.withColumn("_d", done.scalar()).select(
        "rows_raw",
        F.col("_d.rows_final").alias("rows_final"),
        F.col("_d.nulls_filled").alias("nulls_filled"),
        "anomalies_flagged",
        "duplicates_removed",
    )
