"""Connected components of a link table, by alternating large and small stars.

A large star links every larger neighbour of a node to the node's least neighbour; a small star does so for
the others. Both keep components and shorten paths, so a few rounds leave one star per component. Minima are
partial aggregates and every join has one narrow row per node on one side, so a node with very many links is
split like any skewed join key. The links are stored once per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node with a link; the label is the least node of the component.

    ``links``: two columns of node ids; null ends, loops and repeated links are ignored."""
    a, b = (F.col(c) for c in links.columns)
    e = stored(
        links.where((a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select(
            F.col("u").alias("k"), F.least("u", "w").alias("w")
        )
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(
            F.col("v").alias("u"), F.col("w").alias("v")
        ).union(e.join(least, F.col("u") == F.col("k")).where("w < u").select("u", F.col("w").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("k"), "w")
        small = large.join(low, F.col("u") == F.col("k")).where("v <> w").select(
            F.col("v").alias("u"), F.col("w").alias("v")
        ).union(low.select(F.col("k").alias("u"), F.col("w").alias("v")))
        e = stored(small.distinct(), "links")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
