"""Derived columns and reshaping of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar
from ..functions.labels import labels
from ..functions.numeric import by_week, rnd
from ..functions.ranges import blocks, numbered, spread, task_count
from ..sources.tables import TOTAL

BASELINE = 100.0
#: Blocks of names in the grid of names and weeks; weeks are few.
NAME_BLOCKS = 256


def flags(df: DataFrame, baseline: float = BASELINE) -> DataFrame:
    """Add ``above_baseline``; a null value is not above."""
    return df.withColumn("above_baseline", F.coalesce(F.col("idx") > baseline, F.lit(False)))


def rolling(df: DataFrame, *weeks: int) -> DataFrame:
    """Add trailing means ``rolling_<n>w`` over the last n rows, fewer at the start."""
    return df.withColumns(
        {
            f"rolling_{n}w": rnd(F.avg("idx").over(by_week().rowsBetween(1 - n, 0)), 2)
            for n in weeks or (4, 12)
        }
    )


def rolling_ranged(df: DataFrame, order: Sequence[str], *rows: int, by: str = "series", value: str = "idx") -> DataFrame:
    """``rolling`` for series of any length, such as one of single lines: add ``pos``, the place in the series by
    ``order`` (which must tell its rows apart), and trailing means ``rolling_<n>`` over the last n rows.

    Places come from a range exchange, frames run in blocks with a halo; the numbers are those of one window."""
    rows = rows or (4, 12)
    tasks = task_count(df)
    placed, w = blocks(numbered(df, [by], order, "pos", "rolling", tasks), [by], "pos", back=max(rows) - 1)
    means = {f"rolling_{n}": F.avg(value).over(w.rowsBetween(1 - n, 0)) for n in rows}
    done = spread(placed, [by], tasks).withColumns(means).where("_own").drop("_own", "_block")
    return done.withColumns({name: rnd(name, 2) for name in means})


def yoy_rows(df: DataFrame, lag: int = 52) -> DataFrame:
    """Add ``yoy``: the change against the value ``lag`` rows back."""
    return df.withColumn("yoy", rnd(F.col("idx") - F.lag("idx", lag).over(by_week()), 2))


def total_by_week(df: DataFrame, total: str = TOTAL) -> DataFrame:
    """The total series as a lookup by week: one row per calendar week, however many series."""
    return df.where(F.col("series") == total).select(
        F.col("week_ending").alias("_week"), F.col("idx").alias("total_idx")
    )


def with_total_idx(df: DataFrame, total: str = TOTAL) -> DataFrame:
    """The other series with the total's value of the same week (null where it has none)."""
    rest = df.where(F.col("series") != total)
    lookup = total_by_week(df, total)
    return rest.join(lookup, F.col("week_ending") == F.col("_week"), "left").drop("_week")


def vs_total(df: DataFrame, total: str = TOTAL) -> DataFrame:
    """Difference to the total series in the same week; the total itself is left out."""
    return with_total_idx(df, total).withColumn("vs_total", rnd(F.col("idx") - F.col("total_idx"), 2))


def pivot_wide(df: DataFrame, series: Sequence[str], value: str = "idx") -> DataFrame:
    """One row per week, one column per series. The caller names the columns, so that no extra
    pass over the data is made to find them."""
    return df.groupBy("week_ending").pivot("series", list(series)).agg(F.first(value))


def melt(wide: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """Wide to long; columns that do not exist are passed over."""
    have = [c for c in (values or wide.columns) if c in wide.columns and c not in ids]
    return wide.unpivot(list(ids), have, "series", "idx")


def fact_union(region: DataFrame, site: DataFrame, dim: DataFrame) -> DataFrame:
    """Both fact tables as one for free SQL: ``region`` or ``site_type`` holds the key, ``label`` its name."""
    both = region.withColumn("_kind", F.lit("region")).unionByName(site.withColumn("_kind", F.lit("site")))
    named = labels(both, dim)
    return named.select(
        F.when(F.col("_kind") == "region", F.col("series")).alias("region"),
        F.when(F.col("_kind") == "site", F.col("series")).alias("site_type"),
        F.col("label_or_key").alias("label"),
        *[c for c in region.columns if c != "series"],
        "series",
    )


def all_cells(panel: DataFrame, names: DataFrame) -> DataFrame:
    """The rows a melted wide table has: every name in every week of the panel, null where it has no value.

    It comes from the long panel; no series becomes a column on the way. Names are dealt to blocks and every week
    is handed to each block, so the grid is an equal join of many small groups."""
    named = names.select("series").distinct().withColumn("_block", F.pmod(F.xxhash64("series"), F.lit(NAME_BLOCKS)))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(NAME_BLOCKS - 1).cast("bigint"))
    weeks = panel.select("week_ending").distinct().select("week_ending", F.explode(numbers).alias("_block"))
    cells = named.join(weeks, "_block").select("series", "week_ending")
    return cells.join(panel.select("series", "week_ending", "idx"), ["series", "week_ending"], "left")


def fact(panel: DataFrame) -> DataFrame:
    """Table behind the SQL-style reports: panel with calendar, flag and both trailing means."""
    return rolling(flags(calendar(panel)), 4, 12)
