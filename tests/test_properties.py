"""Properties that hold for any panel."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekloom.operators import alerts, clean, forecast, segment, sqlpack, stats, transform

from .frames import by, panel

values = st.lists(st.one_of(st.none(), st.integers(50, 150)), min_size=5, max_size=70).filter(
    lambda v: sum(x is not None for x in v) >= 4
)
few = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(values)
def test_interpolation_keeps_known_values_and_stays_in_range(spark, v):
    got = [r["value_filled"] for r in clean.interpolate(panel(spark, s=v), value="idx").orderBy("week_ending").collect()]
    known = [x for x in v if x is not None]
    assert all(x is None or x == y for x, y in zip(v, got))
    assert all(min(known) <= y <= max(known) for y in got)


@few
@given(values)
def test_decomposition_adds_up_and_bands_are_ordered(spark, v):
    p = clean.interpolate(panel(spark, s=v), value="idx").select("series", "week_ending", F.col("value_filled").alias("idx"))
    gap = F.abs(F.col("observed") - F.col("trend") - F.col("seasonal") - F.col("residual"))
    assert stats.decompose(p).where(gap > 0.0151).count() == 0
    out = forecast.ensemble(p).where("lower_95 <= forecast and forecast <= upper_95")
    assert out.count() == 8


@few
@given(values)
def test_rolling_means_equal_a_plain_loop(spark, v):
    p = panel(spark, s=v)
    got = [r["rolling_4w"] for r in transform.rolling(p, 4).orderBy("week_ending").collect()]
    for i, g in enumerate(got):
        near = [x for x in v[max(0, i - 3): i + 1] if x is not None]
        assert g is None if not near else g == pytest.approx(sum(near) / len(near), abs=0.0051)


@few
@given(st.lists(st.integers(90, 110), min_size=3, max_size=40))
def test_runs_equal_a_plain_loop(spark, v):
    longest = run = 0
    for x in v:
        run = run + 1 if x < 100 else 0
        longest = max(longest, run)
    got = alerts.below_runs(panel(spark, s=v)).collect()[0]
    assert (got["longest_run"], got["current_run"]) == (longest, run)


def test_rank_is_one_plus_the_better_ones(spark):
    rows = {f"s{i}": [100 + (i * 7) % 5, 100 + (i * 3) % 4] for i in range(12)}
    got = by(sqlpack.ranking(panel(spark, **rows)), "series")
    for k, v in rows.items():
        better = sum(sum(o) > sum(v) for o in rows.values())
        assert got[k]["rank_position"] == 1 + better


def test_normalised_features_have_mean_zero_and_deviation_one(spark):
    rows = {f"s{i}": [100 + (i * 7 + w * (i + 3)) % (17 + i) for w in range(60)] for i in range(6)}
    norm = segment.normalise(segment.features(panel(spark, **rows)))
    for f in segment.FEATURES:
        r = norm.agg(F.avg(segment.z(f)).alias("m"), F.stddev_pop(segment.z(f)).alias("s")).collect()[0]
        assert r["m"] == pytest.approx(0, abs=1e-6) and r["s"] == pytest.approx(1, abs=1e-4)
