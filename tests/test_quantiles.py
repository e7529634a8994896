"""Quantiles by sketch and selection against ``percentile``."""

import math
import random

import pytest
from pyspark.sql import functions as F

from weekloom.functions.quantiles import bucket, exact_quantiles

from .frames import by

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def values(seed: int) -> list[float]:
    rng = random.Random(seed)
    kinds = [
        lambda: rng.gauss(100, 20), lambda: -rng.expovariate(0.001), lambda: 0.0, lambda: float(rng.randrange(3)),
        lambda: rng.uniform(1, 2) * 2.0 ** rng.randrange(-1000, 1000), lambda: 5e-324, lambda: math.inf, lambda: -math.inf,
        lambda: math.nextafter(2.0 ** rng.randrange(-40, 40), 0), lambda: 2.0 ** rng.randrange(-40, 40),
    ]
    return [rng.choice(kinds)() for _ in range(rng.randrange(1, 400))]


def test_buckets_follow_the_order(spark):
    found = sorted({v for seed in range(20) for v in values(seed)})
    df = spark.createDataFrame([(v,) for v in found], "v double")
    numbers = [r["b"] for r in df.select("v", bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert numbers == sorted(numbers) and len(set(numbers)) > 1000


def test_equals_percentile(spark):
    rows = [(f"s{seed}", v) for seed in range(30) for v in values(seed) if math.isfinite(v)]
    rows += [("nulls", None), ("nulls", None), ("one", 4.5), ("one", None), (None, 1.0), (None, 3.0)]
    rows += [("hot", 7.25)] * 3000
    df = spark.createDataFrame(rows, "series string, v double").repartition(7)
    want = by(df.groupBy("series").agg(F.percentile("v", SHARES).alias("q")), "series")
    got = by(exact_quantiles(df, "v", SHARES), "_q_series")
    assert got.keys() == want.keys() - {"nulls"}
    for key, row in got.items():
        assert row["q"] == pytest.approx(want[key]["q"], rel=1e-14, abs=5e-324)


def test_no_task_holds_a_series(spark):
    """Values of a series are only ever counted; the buckets that are looked at again are narrow."""
    df = spark.range(200_000, numPartitions=8).select(F.lit("s").alias("series"), (100 + 50 * F.rand(seed=4)).alias("v"))
    got = exact_quantiles(df, "v", [0.25, 0.5])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan
    sizes = df.groupBy(bucket(F.col("v"))).count()
    assert sizes.agg(F.max("count")).first()[0] < 200_000 / 500


def test_empty(spark):
    df = spark.createDataFrame([], "series string, v double")
    assert exact_quantiles(df, "v", [0.5]).count() == 0
