"""Data behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import by_week, rnd
from ..sources.tables import TOTAL
from .transform import rolling


def month_heatmap(panel: DataFrame, total: str = TOTAL) -> DataFrame:
    """Series by month matrix of means, keyed by month, without the total."""
    v, month = F.col("idx"), F.month("week_ending")
    return (
        panel.where(F.col("series") != total)
        .groupBy("series")
        .agg(*[rnd(F.avg(F.when(month == m, v)), 2).alias(f"m{m:02d}") for m in range(1, 13)])
    )


def trends(panel: DataFrame, total: str = TOTAL) -> DataFrame:
    """Lines of all series with the baseline; the total is marked."""
    return panel.select(
        "series",
        "week_ending",
        rnd("idx", 2).alias("idx"),
        F.lit(100.0).alias("baseline"),
        (F.col("series") == total).alias("is_total"),
    )


def site_lines(site: DataFrame) -> DataFrame:
    """Site values with their trailing four-week mean."""
    return rolling(site, 4).select(
        F.col("series").alias("site_type"), "week_ending", rnd("idx", 2).alias("idx"), "rolling_4w"
    )


def ranking_bars(ranked: DataFrame) -> DataFrame:
    """Composite scores as bars, lowest first: the best, the bottom three, the rest. Ranks are unique,
    so the bar is counted from the other end."""
    size = ranked.agg(F.count(F.lit(1))).scalar()
    bars = ranked.select("series", "rank", "composite").withColumn("_n", size)
    bars = bars.withColumn("bar", F.col("_n") + 1 - F.col("rank"))
    group = (
        F.when(F.col("rank") == 1, "best").when(F.col("bar") <= 3, "bottom").otherwise("rest")
    )
    return bars.select("bar", "series", "composite", group.alias("bar_group"))


def forecast_lines(panel: DataFrame, forecast: DataFrame, last: int = 20) -> DataFrame:
    """Newest actual values followed by the forecast with its band."""
    none = F.lit(None).cast("double")
    actual = panel.withColumn("age", F.row_number().over(by_week(descending=True))).where(
        F.col("age") <= last
    )
    actual = actual.select(
        "series",
        "week_ending",
        F.lit("actual").alias("kind"),
        rnd("idx", 2).alias("idx"),
        none.alias("upper_95"),
        none.alias("lower_95"),
    )
    ahead = forecast.select(
        "series",
        "week_ending",
        F.lit("forecast").alias("kind"),
        F.col("forecast").alias("idx"),
        "upper_95",
        "lower_95",
    )
    return actual.unionByName(ahead)


def anomaly_picks(anomalies: DataFrame, high: int = 3, low: int = 2) -> DataFrame:
    """The largest and smallest anomalies of a series, for labels; a row may be in both."""
    picked = ["series", "week_ending", "index", "likely_cause"]
    # a series flags at most its own weeks, so both windows are bounded by the calendar
    w = by_week().partitionBy("series")
    up = F.row_number().over(w.orderBy(F.desc("index"), "week_ending"))
    down = F.row_number().over(w.orderBy("index", "week_ending"))
    ends = anomalies.withColumns({"up": up, "down": down}).withColumn(
        "pick",
        F.explode(
            F.filter(
                F.array(F.when(F.col("up") <= high, "high"), F.when(F.col("down") <= low, "low")),
                lambda p: p.isNotNull(),
            )
        ),
    )
    return ends.select(*picked, "pick")
