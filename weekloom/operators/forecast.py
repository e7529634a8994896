"""Short-horizon forecasts for all series in one job.

One aggregation per series yields everything a forecast needs (recent line, residual spread,
seasonal slots, smoothed level, held-out values); the horizon is exploded from that single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import age, rnd

SLOTS = 53
MODELS = ("Linear+Seasonal", "Exponential MA", "Ensemble")


def fit(
    panel: DataFrame, lookback: int = 26, alpha: float = 0.3, holdout: int = 0
) -> DataFrame:
    """One row per series with the fitted quantities, from all but its newest ``holdout`` values.

    The recent line is fitted on u = -age, so u = i - 1 is the i-th step ahead. The smoothed level
    is the closed form of the recurrence seeded with the first value."""
    v = F.col("idx")
    rows = panel.where(v.isNotNull()).select(
        "series",
        "week_ending",
        "idx",
        (F.weekofyear("week_ending") % SLOTS).alias("slot"),
        (age() - holdout).alias("age"),
        (F.count(F.lit(1)).over(Window.partitionBy("series")) - holdout).alias("n"),
    )
    train = F.col("age") >= 1
    of_slot = F.avg(F.when(train, v)).over(Window.partitionBy("series", "slot"))
    rows = rows.withColumn("slot_mean", of_slot)
    recent = train & (F.col("age") <= lookback)
    y, u = F.when(recent, v), F.when(recent, -F.col("age").cast("double"))
    decay = F.lit(1.0 - alpha)
    share = F.when(F.col("age") == F.col("n"), F.pow(decay, F.col("n") - 1.0)).otherwise(
        F.lit(alpha) * F.pow(decay, F.col("age") - 1.0)
    )
    fitted = rows.groupBy("series").agg(
        F.max("n").alias("n"),
        F.max(F.when(train, F.col("week_ending"))).alias("last_week"),
        F.regr_slope(y, u).alias("slope"),
        F.regr_intercept(y, u).alias("level"),
        F.regr_sxy(y, u).alias("sxy"),
        F.regr_sxx(y, u).alias("sxx"),
        F.regr_syy(y, u).alias("syy"),
        F.regr_count(y, u).cast("double").alias("m"),
        F.avg(F.when(train, v)).alias("mean"),
        F.sum(F.when(train, v * share)).alias("ewma"),
        F.map_from_entries(
            F.collect_set(F.when(train, F.struct("slot", "slot_mean")))
        ).alias("slots"),
        F.map_from_entries(
            F.collect_list(F.when(~train, F.struct((F.col("age") + holdout).alias("a"), v.alias("v"))))
        ).alias("held_out"),
    )
    c = F.col
    left_over = F.greatest(c("syy") - c("slope") * c("sxy"), F.lit(0.0))
    r2 = F.when((c("syy") == 0) | (c("sxx") == 0), 0.0).otherwise(
        c("sxy") * c("sxy") / (c("sxx") * c("syy"))
    )
    return fitted.where(c("n") > 0).withColumns(
        {"r2": r2, "residual_std": F.sqrt(left_over / c("m"))}
    )


def _seasonal(slot: Column) -> Column:
    """Slot mean minus overall mean; 0 for a slot without values."""
    return F.coalesce(F.try_element_at("slots", slot) - F.col("mean"), F.lit(0.0))


def seasonal_index(panel: DataFrame) -> DataFrame:
    """Seasonal deviation of each of the 53 slots (ISO week modulo 53)."""
    slot = F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1)))
    return fit(panel).select("series", "mean", "slots", slot.alias("s")).select(
        "series", F.col("s").cast("bigint").alias("slot"), rnd(_seasonal(F.col("s")), 4).alias("seasonal")
    )


def _steps(
    panel: DataFrame, h: int, w: float, lookback: int, alpha: float, damp: float, holdout: int = 0
) -> DataFrame:
    """Unrolled horizon with the rounded output of the three models."""
    df = fit(panel, lookback, alpha, holdout).withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.lit(h)))
    )
    c = F.col
    step = c("i").cast("double")
    slot = ((F.weekofyear("last_week") + c("i")) % SLOTS).cast("int")
    point = c("level") + c("slope") * (step - 1.0) + _seasonal(slot) * F.lit(damp)
    band = (
        F.lit(1.96) * c("residual_std") * F.sqrt(F.lit(1.0) + F.lit(1.0) / c("m"))
        * (F.lit(1.0) + step * F.lit(0.1))
    )
    df = df.withColumns(
        {
            "lin": rnd(point, 2),
            "lin_hi": rnd(point + band, 2),
            "lin_lo": rnd(point - band, 2),
            "ma": rnd("ewma", 2),
        }
    )
    a, b = F.lit(w), F.lit(1.0 - w)
    return df.withColumns(
        {
            "ens": rnd(a * c("lin") + b * c("ma"), 2),
            "ens_hi": rnd(a * c("lin_hi") + b * (c("ma") + 3.0), 2),
            "ens_lo": rnd(a * c("lin_lo") + b * (c("ma") - 3.0), 2),
            "week_ending": F.date_add("last_week", c("i") * 7),
            "week_ahead": c("i").cast("bigint"),
        }
    )


def linear(panel: DataFrame, h: int = 8, lookback: int = 26, damp: float = 0.3) -> DataFrame:
    """Line through the recent values plus damped seasonal deviation, with a 95 % band."""
    return _steps(panel, h, 0.6, lookback, 0.3, damp).select(
        "series",
        "week_ahead",
        F.col("lin").alias("forecast"),
        F.col("lin_hi").alias("upper_95"),
        F.col("lin_lo").alias("lower_95"),
    )


def linear_model(panel: DataFrame, lookback: int = 26) -> DataFrame:
    """Slope, fit and residual spread of the recent line."""
    return fit(panel, lookback).select(
        "series",
        rnd("slope", 4).alias("slope"),
        rnd("r2", 4).alias("r_squared"),
        rnd("residual_std", 3).alias("residual_std"),
    )


def ewma(panel: DataFrame, alpha: float = 0.3) -> DataFrame:
    """Exponentially smoothed level, which is also the flat forecast."""
    return fit(panel, alpha=alpha).select("series", rnd("ewma", 2).alias("last_ewma"))


def ensemble(
    panel: DataFrame,
    h: int = 8,
    w: float = 0.6,
    lookback: int = 26,
    alpha: float = 0.3,
    damp: float = 0.3,
) -> DataFrame:
    """Weighted mean of both rounded models with band and dates, for every series."""
    return _steps(panel, h, w, lookback, alpha, damp).select(
        "series",
        "week_ahead",
        "week_ending",
        F.col("ens").alias("forecast"),
        F.col("ens_hi").alias("upper_95"),
        F.col("ens_lo").alias("lower_95"),
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Mean forecast per series and its side of the baseline."""
    m = F.avg("forecast")
    return forecast.groupBy("series").agg(
        rnd(m, 1).alias("avg_forecast"),
        F.when(m > 100, "Above 100").otherwise("Below 100").alias("status"),
    )


def evaluate(
    panel: DataFrame,
    test: int = 12,
    w: float = 0.6,
    lookback: int = 26,
    alpha: float = 0.3,
    damp: float = 0.3,
) -> DataFrame:
    """Hold-out errors of the three models over the newest ``test`` weeks, best by RMSE. Series with no
    more than ``test + lookback`` values are left out."""
    steps = _steps(panel, test, w, lookback, alpha, damp, holdout=test).where(
        F.col("n") > lookback
    )
    actual = F.try_element_at("held_out", F.lit(test + 1) - F.col("i"))
    guesses = F.array(
        *[
            F.struct(F.lit(i).alias("o"), F.lit(name).alias("model"), F.col(c).alias("f"))
            for i, (name, c) in enumerate(zip(MODELS, ("lin", "ma", "ens")))
        ]
    )
    rows = steps.select("series", actual.alias("y"), F.explode(guesses).alias("g"))
    e = F.col("y") - F.col("g.f")
    per = rows.groupBy("series", F.col("g.o").alias("o"), F.col("g.model").alias("model")).agg(
        rnd(F.avg(F.abs(e)), 3).alias("mae"),
        rnd(F.sqrt(F.avg(e * e)), 3).alias("rmse"),
        rnd(F.avg(F.abs(e / (F.col("y") + 0.01))) * 100, 2).alias("mape"),
    )
    place = F.row_number().over(Window.partitionBy("series").orderBy("rmse", "o"))
    return per.withColumn("best", place == 1).drop("o")
