"""Alerts, impact estimates, planning calendar and grades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import position, rnd

# Lower limits of the grades.
GRADES = ((80.0, "A"), (65.0, "B"), (50.0, "C"), (35.0, "D"))


def below_runs(panel: DataFrame, n: int = 6, baseline: float = 100.0) -> DataFrame:
    """Longest and current run of weeks below the baseline. Red: a current run of n weeks; amber: a
    current run, or an earlier one of n weeks; green otherwise."""
    below = F.coalesce(F.col("idx") < baseline, F.lit(False))
    rows = panel.select("series", "week_ending", below.alias("below"), position().alias("pos"))
    w = Window.partitionBy("series").orderBy("week_ending")
    last_ok = F.max(F.when(~F.col("below"), F.col("pos"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)
    )
    run = rows.withColumn("run", (F.col("pos") - F.coalesce(last_ok, F.lit(-1))).cast("bigint"))
    per = run.groupBy("series").agg(
        F.max("run").alias("longest_run"), F.max_by("run", "week_ending").alias("current_run")
    )
    status = (
        F.when(F.col("current_run") >= n, "red")
        .when((F.col("current_run") > 0) | (F.col("longest_run") >= n), "amber")
        .otherwise("green")
    )
    return per.withColumn("status", status)


def impact(yoy: DataFrame, per_point: float = 1000.0, margin: float = 0.3) -> DataFrame:
    """Revenue and margin effect of the newest year-on-year change of every series."""
    per = yoy.groupBy("series").agg(F.max_by("yoy_change", "current_week").alias("index_change"))
    money = F.col("index_change") * per_point
    return per.select(
        "series",
        "index_change",
        rnd(money, 2).alias("revenue_change"),
        rnd(money * margin, 2).alias("margin_change"),
    )


def planning(forecast: DataFrame, baseline: float = 100.0) -> DataFrame:
    """Upcoming weeks with the number of series forecast above the baseline."""
    return forecast.groupBy("week_ending").agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(F.col("forecast") > baseline).alias("n_above"),
        rnd(F.avg("forecast"), 2).alias("avg_forecast"),
    )


def grades(ranked: DataFrame) -> DataFrame:
    """A letter per series and score of the composite ranking."""
    dims = ["current", "trend", "stability", "recovery", "peak", "consistency", "composite"]
    long = ranked.unpivot("series", dims, "dimension", "score")
    grade = F.lit("E")
    for limit, letter in reversed(GRADES):
        grade = F.when(F.col("score") >= limit, letter).otherwise(grade)
    return long.withColumn("grade", grade)
