"""Rounding and window helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def rnd(col: Column | str, digits: int) -> Column:
    """Half-even rounding of the scaled double, as numpy does; ``+ 0.0`` turns -0.0 into 0.0."""
    col = F.col(col) if isinstance(col, str) else col
    scale = float(10**digits)
    return F.rint(col * scale) / scale + 0.0


def by_week(descending: bool = False, key: str = "series") -> WindowSpec:
    """The rows of one series in week order. A series has one row per week, so a window
    partition is bounded by the length of the calendar, whatever the input size."""
    order = F.col("week_ending")
    return Window.partitionBy(key).orderBy(order.desc() if descending else order.asc())


def position() -> Column:
    """Zero-based row position of a week inside its series."""
    return F.row_number().over(by_week()) - 1


def age() -> Column:
    """One for the newest week of a series, two for the one before, and so on."""
    return F.row_number().over(by_week(descending=True))
