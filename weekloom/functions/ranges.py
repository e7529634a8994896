"""Whole-table and whole-series order without a one-task window.

Rows are dealt to ranges of their sort keys by a range exchange, so every task has about the same number of rows
and a later range holds later rows only, however long one series is. What a window would carry from row to row
is summed per range and carried from range to range: a table of one row per range (and per group in it).

Frames of neighbouring rows run in blocks of equal numbers of positions; a block also gets copies of the rows
just outside of it that its frames reach (its halo). Blocks are small and many, so tasks stay even.

Long series compress well, and adaptive execution joins partitions by compressed bytes, so a task could get rows by the
million. Steps that sort rows or keep frames are therefore dealt to a number of tasks that follows the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Positions in a block; a block of wider frames has four times their width.
BLOCK = 8192
#: Rows of a task that sorts or keeps frames, on average.
TASK_ROWS = 131_072
_EARLIER = (Window.unboundedPreceding, -1)


def same(names: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of columns with their prefixed copies."""
    out = F.lit(True)
    for c in names:
        out = out & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def task_count(df: DataFrame) -> int:
    """Tasks of ``TASK_ROWS`` rows that ``df`` makes. It is counted, which for a table of files reads their footers."""
    return max(1, math.ceil(df.count() / TASK_ROWS))


def in_ranges(df: DataFrame, keys: Sequence[Column | str], tag: str, tasks: int | None = None) -> DataFrame:
    """``df`` stored in ranges of the keys, with ``_range`` and ``_m``, which counts the rows of a range upwards. There
    are ``tasks`` ranges, or as many as adaptive execution leaves of the shuffle partitions.

    It is stored because the limits of the ranges are sampled: a task that runs again must find the same rows."""
    placed = df.repartitionByRange(*([tasks] if tasks else []), *keys).sortWithinPartitions(*keys)
    placed = placed.withColumn("_m", F.monotonically_increasing_id())
    return stored(placed, tag).withColumn("_range", F.shiftright("_m", 33))


def carried(rows: DataFrame, by: Sequence[str], amount: Column) -> DataFrame:
    """``_c_<by>, _c__range, _first, _before``: per group and range its least ``_m`` and the sum of ``amount`` over
    the group's earlier ranges. Without groups the sums of the ranges, one row a task, are added up on the driver."""
    per = rows.groupBy(*by, "_range").agg(F.sum(amount).alias("_sum"), F.min("_m").alias("_first"))
    named = [F.col(c).alias(f"_c_{c}") for c in (*by, "_range")]
    if by:
        before = F.sum("_sum").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(*_EARLIER))
        return per.select(*named, "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    sums = sorted(per.select("_range", "_first", "_sum").collect())
    before = [0, *accumulate(s for _, _, s in sums)]
    listed = [(r, first, n) for (r, first, _), n in zip(sums, before, strict=False)]
    return rows.sparkSession.createDataFrame(listed, "_c__range bigint, _first bigint, _before bigint")


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str, tag: str = "numbered",
    tasks: int | None = None,
) -> DataFrame:
    """Add ``name``, the zero-based position of a row in its group by ``order``, which must tell rows apart."""
    rows = in_ranges(df, [*by, *order], tag, tasks)
    before = carried(rows, by, F.lit(1))
    # stored, its size is known when the join is planned; if that is small, the rows are not shuffled for it
    placed = rows.join(stored(before, f"{tag}-carried") if by else before, same([*by, "_range"], "_c_"))
    return placed.select(*df.columns, (F.col("_m") - F.col("_first") + F.col("_before")).cast("bigint").alias(name))


def blocks(df: DataFrame, by: Sequence[str], pos: str, back: int = 0, ahead: int = 0) -> tuple[DataFrame, WindowSpec]:
    """Rows with their ``_block`` and ``_own``, copied to the blocks whose frames reach them, and the window of a block.

    Frames of up to ``back`` rows before and ``ahead`` rows after are whole in the block in which a row is its
    own; copies are dropped by ``_own``."""
    size = max(BLOCK, 4 * (back + ahead))
    at = F.col(pos)
    reach = [at] + ([at + back] if back else []) + ([F.greatest(at - ahead, F.lit(0))] if ahead else [])
    numbers = F.array_distinct(F.array(*[F.floor(p / size).cast("bigint") for p in reach]))
    dealt = df.withColumn("_block", F.explode(numbers) if len(reach) > 1 else F.floor(at / size).cast("bigint"))
    own = dealt.withColumn("_own", F.col("_block") == F.floor(at / size))
    return own, Window.partitionBy(*by, "_block").orderBy(pos)


def spread(rows: DataFrame, by: Sequence[str], tasks: int) -> DataFrame:
    """Rows with a ``_block`` dealt to ``tasks`` tasks, whole blocks each, for the windows of blocks."""
    return rows.repartition(tasks, *by, "_block")


def neighbours(rows: DataFrame, by: Sequence[str], value: str, pos: str) -> DataFrame:
    """Two rows at most to add to each block, not its own: the last known value of the group's earlier blocks and the
    first one of its later blocks, at their places. Frames of the block then see what lies beyond it."""
    at = F.when(F.col(value).isNotNull(), F.col(pos))
    # extremes of plain numbers are hashed; those of structs would sort all rows
    per = rows.groupBy(*by, "_block").agg(
        F.max(at).alias("_x1"), F.max_by(value, at).alias("_v1"), F.min(at).alias("_x0"), F.min_by(value, at).alias("_v0")
    )
    last, first = (
        F.when(F.col(f"_x{k}").isNotNull(), F.struct(F.col(f"_x{k}").alias(pos), F.col(f"_v{k}").alias(value))) for k in (1, 0)
    )
    left, right = (Window.partitionBy(*by).orderBy(o).rowsBetween(*_EARLIER) for o in ("_block", F.desc("_block")))
    ends = per.select(*by, "_block", F.array(F.last(last, True).over(left), F.last(first, True).over(right)).alias("_ends"))
    each = ends.select(*by, "_block", F.explode("_ends").alias("_end")).where(F.col("_end").isNotNull())
    return each.select(*by, "_block", F.lit(False).alias("_own"), f"_end.{pos}", f"_end.{value}")
