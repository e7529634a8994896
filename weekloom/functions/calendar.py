"""Week endings and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Season of a month, and ISO weeks that count as holiday weeks (53 does not).
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}
HOLIDAY_WEEKS = (49, 50, 51, 52, 1)


def week_ending(col: Column | str) -> Column:
    """Sunday that closes the ISO week of a date or timestamp."""
    day = (F.col(col) if isinstance(col, str) else col).cast("date")
    return F.date_add(F.trunc(day, "week"), 6)


def _in(values: tuple[int, ...]) -> str:
    return f"in ({', '.join(map(str, values))})"


def calendar(df: DataFrame, col: str = "week_ending") -> DataFrame:
    """Add calendar year, month, ISO week number, quarter, season and the holiday flag."""
    seasons = " ".join(f"when month({col}) {_in(m)} then '{name}'" for name, m in SEASONS.items())
    return df.selectExpr(
        "*",
        f"cast(year({col}) as bigint) as year",
        f"cast(month({col}) as bigint) as month",
        f"cast(weekofyear({col}) as bigint) as week_number",
        f"cast(quarter({col}) as bigint) as quarter",
        f"case {seasons} end as season",
        f"weekofyear({col}) {_in(HOLIDAY_WEEKS)} as is_holiday_week",
    )
