"""The report pack: each function takes a fact table (``transform.fact``) and returns one report.

Averages per series are hash-partitioned by series already (the panel is), so most reports add
no shuffle; ranks go through ``with_rank`` instead of a one-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..functions.ranking import with_rank
from ..sources.tables import TOTAL, latest_week
from .transform import with_total_idx

RECENT_DAYS = 84


def _pct_above(flag: Column) -> Column:
    return F.lit(100.0) * F.count_if(flag) / F.count(F.lit(1))


def _dated(value: Column, sign: int) -> Column:
    """Sort key of a week by value; the earliest week wins among equals."""
    return F.when(
        value.isNotNull(), F.struct(value, F.unix_date("week_ending").cast("bigint") * sign)
    )


def latest(fact: DataFrame) -> DataFrame:
    """Value and three-way status in the newest week, best first."""
    v = F.col("idx")
    status = (
        F.when(v > 100, "Above baseline").when(v == 100, "At baseline").otherwise("Below baseline")
    )
    return (
        fact.where(F.col("week_ending") == latest_week(fact))
        .select("series", "week_ending", rnd("idx", 4).alias("idx"), status.alias("status"))
        .orderBy(F.desc("idx"), "series")
    )


def ranking(fact: DataFrame) -> DataFrame:
    """Mean, extremes and rank of the mean. Takes region rows only: pass the region fact table."""
    v = F.col("idx")
    per = fact.groupBy("series").agg(F.avg(v).alias("m"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    return (
        with_rank(per, "m", "rank_position")
        .select(
            "series",
            rnd("m", 2).alias("avg_index"),
            rnd("lo", 2).alias("min_index"),
            rnd("hi", 2).alias("max_index"),
            rnd(F.col("m") - 100, 2).alias("vs_baseline"),
            "rank_position",
        )
        .orderBy(F.desc("avg_index"), "series")
    )


def peak_trough(fact: DataFrame) -> DataFrame:
    """Best and worst week per series; the earliest week among equals."""
    v = F.col("idx")
    per = fact.groupBy("series").agg(
        F.max(v).alias("hi"),
        F.max_by("week_ending", _dated(v, -1)).alias("peak_week"),
        F.min(v).alias("lo"),
        F.min_by("week_ending", _dated(v, 1)).alias("trough_week"),
    )
    return per.select(
        "series",
        rnd("hi", 4).alias("peak_index"),
        "peak_week",
        rnd("lo", 4).alias("trough_index"),
        "trough_week",
        rnd(F.col("hi") - F.col("lo"), 2).alias("range_amplitude"),
    ).orderBy(F.desc("range_amplitude"), "series")


def month_on_month(fact: DataFrame) -> DataFrame:
    """Monthly mean against the month before; a first month counts as declining."""
    w = Window.partitionBy("series").orderBy("year", "month")
    # the mean's last bits depend on the order of its rows; at nine digits a tie of the second digit is one on every run
    per = fact.groupBy("series", "year", "month").agg(rnd(F.avg("idx"), 9).alias("m"))
    per = per.withColumn("change", F.col("m") - F.lag("m").over(w))
    return per.select(
        "series",
        "year",
        "month",
        rnd("m", 2).alias("monthly_avg"),
        rnd("change", 2).alias("mom_change"),
        F.when(rnd("change", 6) > 0, "Improving").otherwise("Declining").alias("direction"),
    ).orderBy("series", "year", "month")


def year_on_year(fact: DataFrame, days: int = 364) -> DataFrame:
    """Value against the week exactly ``days`` earlier, where there is one. A range frame of a single
    day finds it without a self join."""
    day = F.unix_date("week_ending")
    back = Window.partitionBy("series").orderBy(day).rangeBetween(-days, -days)
    pair = fact.select("series", "week_ending", "idx", F.max("idx").over(back).alias("prior"))
    v, p = F.col("idx"), F.col("prior")
    return (
        pair.where(p.isNotNull())
        .select(
            "series",
            F.col("week_ending").alias("current_week"),
            rnd(v, 4).alias("current_index"),
            rnd(p, 4).alias("prior_year_index"),
            rnd(v - p, 2).alias("yoy_change"),
            rnd((v - p) / F.nullif(p, F.lit(0.0)) * 100, 2).alias("yoy_pct_change"),
        )
    )


def rolling_means(fact: DataFrame) -> DataFrame:
    """Trailing 4- and 12-row means."""
    return fact.select(
        "series",
        "week_ending",
        rnd("idx", 4).alias("idx"),
        F.col("rolling_4w").alias("calc_rolling_4w"),
        F.col("rolling_12w").alias("calc_rolling_12w"),
    ).orderBy("series", "week_ending")


def peak_season(fact: DataFrame, weeks: tuple[int, int] = (49, 52), above: float = 120.0) -> DataFrame:
    """Season weeks above a threshold, ranked per year among the rows that passed."""
    hits = fact.where(F.col("week_number").between(*weeks) & (F.col("idx") > above))
    ranked = with_rank(
        hits.select("series", "year", "week_number", "week_ending", "idx"), "idx", "xmas_rank", by=["year"]
    )
    return ranked.select(
        "series",
        "year",
        "week_number",
        "week_ending",
        rnd("idx", 4).alias("idx"),
        rnd(F.col("idx") - 100, 2).alias("above_baseline_pts"),
        "xmas_rank",
    ).orderBy("year", "xmas_rank", "series")


def slump_season(fact: DataFrame, weeks: tuple[int, int] = (1, 4), below: float = 95.0) -> DataFrame:
    """Season weeks below a threshold, lowest first per year."""
    hits = fact.where(F.col("week_number").between(*weeks) & (F.col("idx") < below))
    ranked = with_rank(
        hits.select("series", "year", "week_number", "week_ending", "idx"),
        "idx", "slump_rank", by=["year"], descending=False,
    )
    return ranked.select(
        "series",
        "year",
        "week_number",
        "week_ending",
        rnd("idx", 4).alias("idx"),
        rnd(F.lit(100.0) - F.col("idx"), 2).alias("below_baseline_pts"),
        "slump_rank",
    ).orderBy("year", "slump_rank", "series")


def against_total(fact: DataFrame, total: str = TOTAL) -> DataFrame:
    """Every series against the total of the same week; no total counts as underperforming."""
    pair = with_total_idx(fact.select("series", "week_ending", "idx"), total)
    v, t = F.col("idx"), F.col("total_idx")
    return pair.select(
        "series",
        "week_ending",
        rnd(v, 4).alias("series_index"),
        rnd(t, 4).alias("total_index"),
        rnd(v - t, 2).alias("vs_total"),
        F.when(v > t, "Outperforming").otherwise("Underperforming").alias("relative_performance"),
    ).orderBy(F.desc("week_ending"), F.desc("vs_total"), "series")


def site_winner(site_fact: DataFrame) -> DataFrame:
    """Site types ranked per month by mean."""
    per = site_fact.groupBy(F.col("series").alias("site_type"), "year", "month").agg(
        F.avg("idx").alias("m")
    )
    return (
        with_rank(per, "m", "monthly_rank", by=["year", "month"])
        .select("year", "month", "site_type", rnd("m", 2).alias("avg_index"), "monthly_rank")
        .orderBy("year", "month", "monthly_rank", "site_type")
    )


def consistency(fact: DataFrame, min_weeks: int = 10) -> DataFrame:
    """Share of weeks above baseline and its class; short series are left out."""
    above = F.col("idx") > 100
    per = fact.groupBy("series").agg(
        F.count(F.lit(1)).alias("total_weeks"),
        F.count_if(above).alias("weeks_above"),
        _pct_above(above).alias("pct"),
    )
    return (
        per.where(F.col("total_weeks") >= min_weeks)
        .select(
            "series",
            "total_weeks",
            "weeks_above",
            rnd("pct", 1).alias("pct_above_baseline"),
            F.when(F.col("pct") > 80, "Consistent Performer")
            .when(F.col("pct") > 50, "Mixed Performance")
            .otherwise("Below Average")
            .alias("classification"),
        )
        .orderBy(F.desc("pct_above_baseline"), "series")
    )


def top_weeks(fact: DataFrame, n: int = 5) -> DataFrame:
    """The n highest rows overall with the kind of period they fall in."""
    period = (
        F.when(F.col("week_number").between(49, 52), "Christmas period")
        .when(F.col("month").between(7, 8), "Summer peak")
        .otherwise("Other")
    )
    return (
        fact.orderBy(F.desc("idx"), "series", "week_ending")
        .limit(n)
        .select(
            "series", "week_ending", rnd("idx", 4).alias("idx"), "season", "week_number",
            period.alias("period_context"),
        )
    )


def seasonal_profile(fact: DataFrame, total: str = TOTAL) -> DataFrame:
    """Mean of the total series by ISO week, with a season class."""
    m = F.col("m")
    per = (
        fact.where(F.col("series") == total)
        .groupBy("week_number")
        .agg(
            F.avg("idx").alias("m"),
            F.count(F.lit(1)).alias("sample_size"),
            F.min("idx").alias("lo"),
            F.max("idx").alias("hi"),
        )
    )
    return per.select(
        "week_number",
        rnd(m, 2).alias("seasonal_index"),
        rnd(m - 100, 2).alias("vs_baseline"),
        "sample_size",
        rnd("lo", 2).alias("week_min"),
        rnd("hi", 2).alias("week_max"),
        F.when(m > 115, "HIGH season")
        .when(m > 105, "MODERATE season")
        .when(m > 95, "LOW season")
        .otherwise("TROUGH season")
        .alias("season_class"),
    ).orderBy("week_number")


def quarters(fact: DataFrame) -> DataFrame:
    """Quarter statistics and the change against the same quarter of the year before."""
    w = Window.partitionBy("series", "quarter").orderBy("year")
    per = fact.groupBy("series", "year", "quarter").agg(
        F.avg("idx").alias("m"),
        F.min("idx").alias("lo"),
        F.max("idx").alias("hi"),
        F.count(F.lit(1)).alias("weeks_in_quarter"),
    )
    return per.select(
        "series",
        "year",
        "quarter",
        rnd("m", 2).alias("q_avg"),
        rnd("lo", 2).alias("q_min"),
        rnd("hi", 2).alias("q_max"),
        "weeks_in_quarter",
        rnd(F.col("m") - F.lag("m").over(w), 2).alias("yoy_q_change"),
    ).orderBy("series", "year", "quarter")


def dashboard(fact: DataFrame, recent_days: int = RECENT_DAYS) -> DataFrame:
    """State, averages, recent trend, rank and health of every series that has the newest week.

    One conditional aggregation replaces four passes joined on the series; the rank is taken over
    all series before those without a newest week drop out."""
    v, week = F.col("idx"), F.col("week_ending")
    dated = fact.select("series", "week_ending", "idx", latest_week(fact).alias("newest"))
    per = dated.groupBy("series").agg(
        F.count_if(week == F.col("newest")).alias("here"),
        F.max(F.when(week == F.col("newest"), v)).alias("now"),
        F.avg(v).alias("m"),
        F.max(v).alias("hi"),
        F.min(v).alias("lo"),
        F.avg(F.when(week >= F.date_sub(F.col("newest"), recent_days), v)).alias("recent"),
    )
    out = with_rank(per, "m", "overall_rank").where(F.col("here") > 0).select(
        "series",
        F.col("now"),
        rnd("m", 2).alias("avg_index"),
        rnd("hi", 2).alias("peak_index"),
        rnd("lo", 2).alias("trough_index"),
        rnd("recent", 2).alias("last_12w_avg"),
        "overall_rank",
    )
    now, mean = F.col("now"), F.col("avg_index")
    health = (
        F.when((now > mean) & (F.col("last_12w_avg") > mean), "Strong")
        .when(now > 100, "Moderate")
        .otherwise("Weak")
    )
    return out.select(
        "series",
        rnd(now, 4).alias("current_index"),
        "avg_index",
        "peak_index",
        "trough_index",
        "last_12w_avg",
        rnd(now - mean, 2).alias("vs_average"),
        "overall_rank",
        health.alias("health_status"),
    ).orderBy("overall_rank", "series")


def summary_view(fact: DataFrame, name: str | None = None) -> DataFrame:
    """Newest-week snapshot with its rank; registered as a temporary view when named."""
    snap = fact.where(F.col("week_ending") == latest_week(fact)).select(
        "series", "week_ending", "idx", "rolling_4w", "rolling_12w", "above_baseline", "season"
    )
    out = with_rank(snap, "idx", "current_rank").select(
        "series",
        "week_ending",
        rnd("idx", 4).alias("current_index"),
        F.col("rolling_4w").alias("rolling_4w_avg"),
        F.col("rolling_12w").alias("rolling_12w_avg"),
        "above_baseline",
        "season",
        "current_rank",
    )
    if name:
        out.createOrReplaceTempView(name)
    return out


def series_report(fact: DataFrame, series: str) -> DataFrame:
    """Report for one series, named by the caller. The filter is on the panel's key, so with a panel
    built without the total it reaches the dimension scan and prunes the join."""
    v = F.col("idx")
    per = fact.where(F.col("series") == series).groupBy("series").agg(
        F.count(F.lit(1)).alias("total_weeks"),
        rnd(F.avg(v), 2).alias("mean_index"),
        rnd(F.min(v), 2).alias("min_index"),
        rnd(F.max(v), 2).alias("max_index"),
        rnd(F.avg(F.when(F.col("season") == "Summer", v)), 2).alias("summer_avg"),
        rnd(F.avg(F.when(F.col("season") == "Winter", v)), 2).alias("winter_avg"),
        rnd(F.avg(F.when(F.col("month") == 12, v)), 2).alias("december_avg"),
        rnd(F.avg(F.when(F.col("month") == 1, v)), 2).alias("january_avg"),
        F.count_if("above_baseline").alias("weeks_above_100"),
        rnd(_pct_above(F.col("above_baseline")), 1).alias("pct_above"),
    )
    return per.select(F.lit("REGIONAL REPORT").alias("report_type"), "*")


def register_report(fact: DataFrame, function: str = "series_report", view: str = "weekly_fact") -> None:
    """Make ``series_report`` callable from SQL, as a table function with a named argument:
    ``SELECT * FROM series_report(wanted => 'NATION_7')``, also with a parameter marker of ``spark.sql(..., args)``.

    The function is a query over the fact table's view, not code: Spark puts its text in place of the call, so the
    filter on the series goes down to the dimension scan, and calls can be joined or filtered like any table."""
    register(fact, view)

    def rounded(expr: str, digits: int) -> str:
        return f"rint(({expr}) * 1e{digits}D) / 1e{digits}D + 0D"

    def mean(condition: str) -> str:
        return rounded(f"avg(idx) FILTER (WHERE {condition})", 2)

    columns = {
        "report_type STRING": "'REGIONAL REPORT'",
        "series STRING": "series",
        "total_weeks BIGINT": "count(*)",
        "mean_index DOUBLE": rounded("avg(idx)", 2),
        "min_index DOUBLE": rounded("min(idx)", 2),
        "max_index DOUBLE": rounded("max(idx)", 2),
        "summer_avg DOUBLE": mean("season = 'Summer'"),
        "winter_avg DOUBLE": mean("season = 'Winter'"),
        "december_avg DOUBLE": mean("month = 12"),
        "january_avg DOUBLE": mean("month = 1"),
        "weeks_above_100 BIGINT": "count_if(above_baseline)",
        "pct_above DOUBLE": rounded("100D * count_if(above_baseline) / count(*)", 1),
    }
    fact.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(wanted STRING) RETURNS TABLE ({', '.join(columns)}) "
        f"RETURN SELECT {', '.join(columns.values())} FROM {view} WHERE series = {function}.wanted GROUP BY series"
    )


def register(fact: DataFrame, view: str = "weekly_fact") -> DataFrame:
    """Make the fact table available to free SQL under a name; returns it unchanged."""
    fact.createOrReplaceTempView(view)
    return fact
