"""Block grid for results that are a matrix over all pairs of series.

Series are hashed into blocks of about ``BLOCK_ROWS``; a pair of blocks is one cell, and the
cells are what Spark shuffles. A series is sent to each of the B blocks once instead of being
joined to every other series, a task holds two blocks, and no cross join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1024


def grid(
    df: DataFrame, key: str, counted: str, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows as left and right members of the upper-triangular cells ``(cell_i, cell_j)``.

    The number of blocks comes from the rows with a ``counted`` value. Counting a computed column
    keeps the plan below equal to the main one, so that its exchange is reused instead of the
    source being scanned again."""
    seen = F.count(F.col(counted))
    n_blocks = df.agg(F.greatest(F.ceil(seen / F.lit(block_rows)), F.lit(1)).cast("int")).scalar()
    # never null, or the join on the cells would push null filters into one side's scan and the two
    # sides could no longer share it
    placed = df.withColumn("_blocks", F.coalesce(n_blocks, F.lit(1))).withColumn(
        "_block", F.coalesce(F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"), F.lit(0))
    )
    left = placed.withColumn("cell_i", F.col("_block")).withColumn(
        "cell_j", F.explode(F.sequence(F.col("_block"), F.col("_blocks") - 1))
    )
    right = placed.withColumn("cell_j", F.col("_block")).withColumn(
        "cell_i", F.explode(F.sequence(F.lit(0), F.col("_block")))
    )
    # new column identities on the right side, so that both sides can meet in one plan
    return left.drop("_block", "_blocks"), right.select(
        *[F.col(c).alias(c) for c in (*df.columns, "cell_i", "cell_j")]
    )
