"""Small frames for the tests."""

from __future__ import annotations

from datetime import date, timedelta

PANEL = "series string, week_ending date, idx double"


def weeks(start: str, n: int, step: int = 7) -> list[date]:
    d = date.fromisoformat(start)
    return [d + timedelta(days=step * i) for i in range(n)]


def panel(spark, start: str = "2023-01-01", **series):
    """One row per series and week from lists of values."""
    rows = [
        (name, week, None if v is None else float(v))
        for name, values in series.items()
        for week, v in zip(weeks(start, len(values)), values)
    ]
    return spark.createDataFrame(rows, PANEL)


def by(df, *keys: str) -> dict:
    """Rows of a result by key."""
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in keys)
        out[k[0] if len(k) == 1 else k] = r
    return out
