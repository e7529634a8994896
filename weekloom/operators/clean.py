"""Parsing, de-duplication, densifying and interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import blocks, neighbours, numbered, spread, task_count
from ..sources.feed import SERIAL_ORIGIN
from ..sources.scratch import stored
from ..sources.tables import week_bounds

DIGITS = r"^[0-9]+(\.[0-9]+)?$"
#: Day counts read as Excel serials (1954-10-03 to 2119-01-11); other digits are no serial.
SERIAL_MIN, SERIAL_MAX = 20_000, 80_000
#: Years a week may lie in; a date outside is as unreadable as text, because it would widen the calendar.
YEAR_MIN, YEAR_MAX = 1900, 2199
#: Date texts that are read besides ISO dates and timestamps, tried in this order (month before day).
DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "d.M.yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")


def is_serial(col: Column | str) -> Column:
    """True for text that is a day count in the range of serials."""
    col = F.col(col) if isinstance(col, str) else col
    text = F.trim(col)
    days = F.when(text.rlike(DIGITS), text.try_cast("double"))
    return F.coalesce(days.between(SERIAL_MIN, SERIAL_MAX), F.lit(False))


def parse_week(col: Column | str) -> Column:
    """Date of a week text; null if it is none of these: ISO, eight digits (yyyyMMdd), a serial in range, or one
    of ``DATE_FORMATS``. Digits never reach the cast, which would read ``45480`` as a year."""
    col = F.col(col) if isinstance(col, str) else col
    text = F.trim(col)
    days = text.try_cast("double").try_cast("int")
    worded = F.coalesce(
        text.try_cast("date"), *[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in DATE_FORMATS]
    )
    found = (
        F.when(text.rlike("^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))
        .when(is_serial(col), F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), days))
        .when(~text.rlike(DIGITS), worded)
    )
    # bound to a name, so that no format is parsed once for the year and once more for the value
    return F.transform(F.array(found), lambda d: F.when(F.year(d).between(YEAR_MIN, YEAR_MAX), d))[0]


def to_number(col: Column | str) -> Column:
    """Text to double; text that is no finite number is null."""
    col = F.col(col) if isinstance(col, str) else col
    value = F.trim(col).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def week_texts(raw: DataFrame) -> DataFrame:
    """``_text, week_ending, n``: the distinct week texts of a feed with their dates and rows. A feed repeats few texts
    in many rows; each text is parsed once, and the table is stored."""
    texts = raw.groupBy(F.col("week_raw").alias("_text")).agg(F.count(F.lit(1)).alias("n"))
    return stored(texts.select("_text", parse_week("_text").alias("week_ending"), "n"), "week-texts")


def with_weeks(raw: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Raw feed with parsed ``week_ending``, looked up in its week texts. Without given ``texts`` the feed is read
    twice: hand over a stored table."""
    weeks = (week_texts(raw) if texts is None else texts).select("_text", "week_ending")
    return raw.join(weeks, F.col("week_raw") == F.col("_text"), "left").drop("_text")


def typed(raw: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Raw feed with parsed ``week_ending`` and ``value`` next to the raw columns; a typed feed is left as it is."""
    if {"week_ending", "value"} <= set(raw.columns):
        return raw
    return with_weeks(raw, texts).withColumn("value", to_number("value_raw"))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order``, which must tell all copies of a key apart. It is an
    aggregate, not a window: copies of one hot key are reduced on the map side and never meet in one
    task."""
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.min_by(c, place).alias(c) for c in rest])


def densify(df: DataFrame, bounds: Column, value: str) -> DataFrame:
    """Give every series a row for each week between the bounds; new rows have a null value.

    Each row also emits the missing weeks up to its successor (the first row those before it,
    the last those after it), so neither a calendar cross join nor a lookup join is needed."""
    over = "over (partition by series order by week_ending)"
    spans = df.withColumn("_b", bounds).selectExpr(
        "*", f"lag(week_ending) {over} as _prev", f"lead(week_ending) {over} as _next"
    )
    back = "if(_prev is null, datediff(week_ending, _b.lo) div 7, 0)"
    ahead = "if(_next is null, datediff(_b.hi, week_ending) div 7, datediff(_next, week_ending) div 7 - 1)"
    offsets = f"sequence(-cast(greatest({back}, 0) as int), cast(greatest({ahead}, 0) as int))"
    return spans.selectExpr("series", "week_ending", value, f"explode({offsets}) as _k").selectExpr(
        "series",
        "date_add(week_ending, _k * 7) as week_ending",
        f"if(_k = 0, {value}, null) as {value}",
    )


def interpolate(
    df: DataFrame,
    by: str = "series",
    order: str = "week_ending",
    value: str = "value",
    out: str = "value_filled",
) -> DataFrame:
    """Linear interpolation by row position; edge nulls take the nearest value.

    Both neighbours come from running frames, one in each sort direction, so the cost per series is
    linear; the ascending one comes last and leaves the rows sorted for the windows that follow.
    Positions are counted from the end, which changes no ratio."""
    over, upto = f"over (partition by {by} order by {order}", "rows unbounded preceding)"
    known = f"if({value} is null, null, struct(_x as x, {value} as v))"
    keep = df.columns
    near = df.selectExpr("*", f"-cast(row_number() {over} desc) as double) as _x")
    near = near.selectExpr("*", f"last({known}, true) {over} desc {upto} as _n")
    near = near.selectExpr("*", f"last({known}, true) {over} asc {upto} as _p")
    between = "_p.v + (_n.v - _p.v) * ((_x - _p.x) / (_n.x - _p.x))"
    filled = (
        f"case when {value} is not null then {value} when _p is null then _n.v "
        f"when _n is null then _p.v else {between} end"
    )
    return near.selectExpr(*keep, f"{filled} as {out}")


def interpolate_ranged(
    df: DataFrame, order: Sequence[str], by: str = "series", value: str = "idx", out: str = "idx_filled"
) -> DataFrame:
    """``interpolate`` for series of any length; ``pos`` is added, the place in the series by ``order`` (which must
    tell its rows apart). Known neighbours beyond a block are added to it as rows."""
    tasks = task_count(df)
    rows, w = blocks(numbered(df, [by], order, "pos", "interpolate", tasks), [by], "pos")
    beyond = neighbours(rows, [by], value, "pos")
    dealt = spread(rows.unionByName(beyond, allowMissingColumns=True), [by], tasks)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("pos").cast("double").alias("x"), F.col(value).alias("v")))
    # both neighbours come from running frames, one in each direction, so the cost of a block is linear
    back = Window.partitionBy(by, "_block").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    near = dealt.withColumn("_n", F.last(known, True).over(back)).withColumn(
        "_p", F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).where("_own")
    before, after = F.col("_p"), F.col("_n")
    share = (F.col("pos").cast("double") - before["x"]) / (after["x"] - before["x"])
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value)).when(before.isNull(), after["v"])
        .when(after.isNull(), before["v"]).otherwise(before["v"] + (after["v"] - before["v"]) * share)
    )
    return near.select(*df.columns, "pos", filled.alias(out))


def clean_feed(raw: DataFrame, fill_weeks: bool = True) -> DataFrame:
    """Parse, set unreadable dates aside, keep the first copy, densify (if asked), interpolate."""
    rows = typed(raw).where(F.col("week_ending").isNotNull())
    kept = dedupe_first(
        rows.select("series", "week_ending", "value", "ingest_seq"),
        ["series", "week_ending"],
        ["ingest_seq"],
    )
    if not fill_weeks:
        return interpolate(kept.select("series", "week_ending", "value"))
    # the value rides along so that this plan needs the same columns as the main one and shares
    # its exchange
    seen = F.struct("week_ending", "value")
    ends = rows.agg(F.min(seen).alias("lo"), F.max(seen).alias("hi"))
    bounds = ends.select(
        F.struct(F.col("lo.week_ending").alias("lo"), F.col("hi.week_ending").alias("hi"))
    ).scalar()
    return interpolate(densify(kept, bounds, "value"))


def clean_panel(panel: DataFrame) -> DataFrame:
    """Dense, gap-free panel ``series, week_ending, idx`` for statistics and forecasts."""
    dense = densify(panel.select("series", "week_ending", "idx"), week_bounds(panel), "idx")
    return interpolate(dense, value="idx", out="idx_filled").select(
        "series", "week_ending", F.col("idx_filled").alias("idx")
    )
