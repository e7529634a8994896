"""Exact quantiles with bounded state: a mergeable sketch, then selection inside one bucket.

The sketch counts values per bucket of equal relative width, ``PER_OCTAVE`` to a factor of two; counts of parts of the
data add up, so it is an ordinary aggregate with map-side combine. Running counts tell which bucket holds the
rank that is asked for. Only the values of those buckets are looked at again, as counts of distinct values in
order, and the ranks are picked there. No task holds the values of a series, and the result is that of
``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets between a value and its double.
PER_OCTAVE = 4096
#: More than the number of the bucket of any positive double, counted from the least one.
_ABOVE = 1 << 23
_UPTO = (Window.unboundedPreceding, 0)


def bucket(value: Column) -> Column:
    """Number of a value's bucket; it never falls as the value rises. NaN is above infinity."""
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    part = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * PER_OCTAVE)
    positive = octave * PER_OCTAVE + part + _ABOVE
    return (
        F.when(F.isnan(value), 4 * _ABOVE).when(value == 0, 0)
        .when(size == float("inf"), F.signum(value) * 3 * _ABOVE).otherwise(F.signum(value) * positive)
    ).cast("bigint")


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], by: str = "series") -> DataFrame:
    """``_q_<by>, q``: the quantiles of the known values per group, interpolated like ``percentile``. Groups without
    a known value are left out. ``df`` is read twice; hand over a stored table."""
    rows = df.where(F.col(value).isNotNull()).select(F.col(by).alias("_s"), F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_b", bucket(F.col("_v")))
    run = Window.partitionBy("_s").orderBy("_b").rowsBetween(*_UPTO)
    sketch = rows.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_s", "_b", "_n", F.sum("_n").over(run).alias("_upto"),
        F.sum("_n").over(Window.partitionBy("_s")).alias("_total"),
    )
    places = [F.lit(float(q)) * (F.col("_total") - 1) for q in shares]
    ranks = [(F.floor(p), F.ceil(p)) for p in places]
    base = F.col("_upto") - F.col("_n")
    holds = F.exists(F.array(*[r for pair in ranks for r in pair]), lambda r: (r >= base) & (r < F.col("_upto")))
    picked = sketch.where(holds).select(
        F.col("_s").alias("_ps"), F.col("_b").alias("_pb"), base.alias("_base"), "_total"
    )
    inside = rows.join(picked, F.col("_s").eqNullSafe(F.col("_ps")) & (F.col("_b") == F.col("_pb"))).groupBy(
        "_s", "_b", "_base", "_total", "_v"
    ).agg(F.count(F.lit(1)).alias("_n"))
    last = F.col("_base") + F.sum("_n").over(Window.partitionBy("_s", "_b").orderBy("_v").rowsBetween(*_UPTO))
    counted = inside.select("_s", "_v", "_total", "_n", last.alias("_upto"))
    here = [F.max(F.when((r >= base) & (r < F.col("_upto")), F.col("_v"))) for pair in ranks for r in pair]
    found = counted.groupBy("_s", "_total").agg(*[h.alias(f"_r{i}") for i, h in enumerate(here)])
    out = []
    for i, (p, (lo, hi)) in enumerate(zip(places, ranks, strict=True)):
        a, b = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
        out.append(F.when(a == b, a).otherwise((hi - p) * a + (p - lo) * b))
    return found.select(F.col("_s").alias(f"_q_{by}"), F.array(*out).alias("q"))
