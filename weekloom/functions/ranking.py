"""RANK and ROW_NUMBER over a whole table without a one-task window.

``rank() over (order by x)`` puts every row into one partition. Here equal values are counted first, with
map-side combine, and the counts go through a range exchange (``ranges``): a rank is the rows of better ranges,
carried from range to range, plus the better rows of the own range, plus one. The number of ranges follows the
shuffle partitions, a value is one row however many rows share it, and the ranked rows are planned once.

ROW_NUMBER needs no counts: value and tie-break tell rows apart, so the rows themselves are numbered in ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .numeric import rnd
from .ranges import carried, in_ranges, numbered, same


def _order(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def with_rank(
    df: DataFrame,
    value: str,
    name: str,
    by: Sequence[str] = (),
    descending: bool = True,
    digits: int = 6,
) -> DataFrame:
    """Add ``name`` = SQL RANK of ``value`` (compared at ``digits`` decimals), nulls last."""
    keyed = stored(df.withColumn("_v", rnd(value, digits)), "ranked")
    tally = keyed.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    rows = in_ranges(tally, [*by, _order("_v", descending)], "rank-tally")
    inside = Window.partitionBy(*by, "_range").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("_near", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranks = near.join(carried(rows, by, F.col("_n")), same([*by, "_range"], "_c_")).select(
        *[F.col(c).alias(f"_r_{c}") for c in (*by, "_v")],
        (F.col("_before") + F.col("_near") + 1).cast("bigint").alias(name),
    )
    return keyed.join(ranks, same([*by, "_v"], "_r_")).select(*df.columns, name)


def with_position(
    df: DataFrame, value: str, tiebreak: str, name: str, descending: bool = True, digits: int = 6
) -> DataFrame:
    """Add ``name`` = ROW_NUMBER by ``value`` with exact ties ordered by ``tiebreak``, which tells them apart."""
    keyed = df.withColumn("_v", rnd(value, digits))
    placed = numbered(keyed, [], [_order("_v", descending), F.col(tiebreak)], "_p", "ranked")
    return placed.select(*df.columns, (F.col("_p") + 1).alias(name))
