"""Series of any length: range exchange, carried sums, blocks with halos."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom.functions import ranges
from weekloom.operators import clean, stats, transform

from .frames import by, weeks
from .plans import executed

random.seed(11)


@pytest.fixture
def many_ranges(spark):
    """64 shuffle partitions that stay apart."""
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def even(sizes) -> bool:
    sizes = sorted(sizes)
    return len(sizes) >= 60 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_one_very_long_series_is_spread(many_ranges):
    """Ten million rows of one series: every step has all its tasks, none with over three times the median."""
    spark, n = many_ranges, 10_000_000
    df = spark.range(n, numPartitions=16).select(
        F.lit("s").alias("series"), F.pmod(F.col("id") * 7919, F.lit(n)).alias("at"), (F.col("id") % 1000).cast("double").alias("idx")
    )
    dealt = ranges.in_ranges(df, ["series", "at"], "test")
    assert even(r["count"] for r in dealt.groupBy("_range").count().collect())
    assert ranges.numbered(df, ["series"], ["at"], "pos").where("pos <> at").count() == 0
    got = transform.rolling_ranged(df, ["at"], 4, 12)
    sizes = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("rolling_12").alias("s")).collect()
    assert even(r["n"] for r in sizes) and sum(r["n"] for r in sizes) == n


def long_and_short(spark):
    """A long series, short ones, one row, a null name, nulls at both ends and in runs."""
    rows = []
    for name, n in (("long", 9000), ("a", 200), ("b", 40), ("c", 7), ("one", 1), (None, 60), ("empty", 30)):
        for k, week in enumerate(weeks("1900-01-07", n)):
            gap = name == "empty" or k < 3 or n - k < 4 or random.random() < 0.3 or 3000 < k < 6500
            rows.append((name, week, None if gap and name != "one" else random.gauss(100, 15)))
    random.shuffle(rows)
    return spark.createDataFrame(rows, "series string, week_ending date, idx double").repartition(5)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 16)


def test_positions(many_ranges):
    df = long_and_short(many_ranges)
    got = ranges.numbered(df, ["series"], ["week_ending"], "pos")
    w = Window.partitionBy("series").orderBy("week_ending")
    assert got.withColumn("want", F.row_number().over(w) - 1).where("pos <> want").count() == 0
    assert got.count() == df.count()


def test_rolling_equals_the_window(many_ranges, small_blocks):
    df = long_and_short(many_ranges)
    want = by(transform.rolling(df, 4, 12, 70), "series", "week_ending")
    got = by(transform.rolling_ranged(df, ["week_ending"], 4, 12, 70), "series", "week_ending")
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert [got[key][f"rolling_{n}"] for n in (4, 12, 70)] == [row[f"rolling_{n}w"] for n in (4, 12, 70)]


def test_interpolation_equals_the_window(many_ranges, small_blocks):
    df = long_and_short(many_ranges)
    want = by(clean.interpolate(df, value="idx", out="v"), "series", "week_ending")
    got = by(clean.interpolate_ranged(df, ["week_ending"], out="v"), "series", "week_ending")
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key]["v"] == pytest.approx(row["v"], rel=1e-12) if row["v"] is not None else got[key]["v"] is None


def test_decomposition_equals_the_window(many_ranges, small_blocks):
    df = long_and_short(many_ranges)
    want = by(stats.decompose(df), "series", "week_ending")
    got = by(stats.decompose_ranged(df, ["week_ending"]), "series", "week_ending")
    assert got.keys() == want.keys()
    for key, row in want.items():
        for c in ("observed", "trend", "seasonal", "residual"):
            assert got[key][c] == pytest.approx(row[c], abs=0.011) if row[c] is not None else got[key][c] is None


def test_rows_of_a_task_do_not_follow_the_shuffle_partitions(spark):
    """Four million rows at eight shuffle partitions: no task of the frames has many times the rows a task should have."""
    n = 4_000_000
    df = spark.range(n).select(
        F.lit("s").alias("series"), F.col("id").alias("at"), F.when(F.col("id") % 5 > 0, F.col("id") % 1000.0).alias("idx")
    )
    for got in (clean.interpolate_ranged(df, ["at"]), transform.rolling_ranged(df, ["at"], 4)):
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) < 300_000


def test_neighbours_of_blocks_are_hashed_not_sorted(spark, small_blocks):
    """The known values at the ends of blocks come from one pass in memory of one row a block."""
    df = long_and_short(spark).select("series", F.monotonically_increasing_id().alias("at"), "idx")
    assert "SortAggregate" not in executed(clean.interpolate_ranged(df, ["at"]))


def test_decomposition_joins_nothing_on_the_series_alone(spark, monkeypatch):
    """Such a join puts a whole series into one task, as its length did."""
    plans = []
    monkeypatch.setattr(stats, "stored", lambda df, tag: plans.append(executed(df)) or ranges.stored(df, tag))
    df = long_and_short(spark)
    plans.append(executed(stats.decompose_ranged(df, ["week_ending"])))
    keys = [k for plan in plans for k in re.findall(r"Join \[([^\]]*)\]", plan)]
    assert len(plans) == 2 and keys and all("_range" in k for k in keys)


def test_lengths_around_the_window(spark, small_blocks):
    """Series of just under, at and over the window, and of a block, decompose as in one window."""
    sizes = (1, 2, 3, 50, 51, 52, 53, 203, 204, 205, 256, 410)
    rows = [(f"s{n}", week, random.gauss(100, 15)) for n in sizes for week in weeks("2001-01-07", n)]
    df = spark.createDataFrame(rows, "series string, week_ending date, idx double")
    want = by(stats.decompose(df), "series", "week_ending")
    got = by(stats.decompose_ranged(df, ["week_ending"]), "series", "week_ending")
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert all(got[key][c] == pytest.approx(row[c], abs=0.011) for c in ("observed", "trend", "seasonal", "residual"))


def test_empty_input(spark):
    none = spark.createDataFrame([], "series string, week_ending date, idx double")
    assert transform.rolling_ranged(none, ["week_ending"]).count() == 0
    assert clean.interpolate_ranged(none, ["week_ending"]).count() == 0
    assert stats.decompose_ranged(none, ["week_ending"]).count() == 0
    assert ranges.numbered(none, [], ["series", "week_ending"], "p").count() == 0
