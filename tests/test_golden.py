"""Published results of one national series, reproduced."""

import pytest
from pyspark.sql import functions as F

from weekloom.operators import forecast, segment, stats

from . import golden
from .frames import by, panel


@pytest.fixture(scope="module")
def total(spark):
    return panel(spark, golden.START, UK_total=golden.TOTAL).cache()


def one(df):
    (row,) = df.collect()
    return row


def test_describe(total):
    r = one(stats.describe(total))
    got = (r["mean"], r["median"], r["std"], r["min"], r["max"], r["p25"], r["p75"])
    assert got == (108.92, 106.9, 10.32, 89.0, 136.7, 102.82, 115.28)


def test_summary(total):
    r = one(stats.summary(total))
    assert (r["latest"], r["above_baseline_pct"]) == (101.5, 86.7)
    c = one(stats.coverage(total))
    assert (str(c["start"]), str(c["end"]), c["weeks"]) == ("2024-07-07", "2026-03-22", 90)


def test_trend(total):
    r = one(stats.trend(total))
    assert (r["slope"], r["intercept"], r["r_squared"], r["std_error"], r["direction"]) == (
        -0.0677, 111.94, 0.0294, 0.0415, "MODERATE_DOWN",
    )
    assert one(stats.trend_p(total))["p_value"] == 0.106405


def test_decomposition(total):
    rows = [r for r in stats.decompose(total).orderBy("week_ending").collect()]
    for i, (trend, seasonal, residual) in {
        0: (115.28, -0.29, -3.19), 40: (108.38, -4.48, 0.0), 89: (107.11, -4.54, -1.08)
    }.items():
        r = rows[i]
        assert r["trend"] == pytest.approx(trend, abs=0.011)
        assert (r["seasonal"], r["residual"]) == pytest.approx((seasonal, residual), abs=0.011)
    s = one(stats.season_summary(total))
    assert (s["peak_week"], s["trough_week"], s["amplitude"]) == (51, 2, 45.99)


def test_anomalies(total):
    rows = stats.anomalies(total).orderBy("week_ending").collect()
    assert [(str(r["week_ending"]), r["index"], r["z_score"], r["method"], r["likely_cause"]) for r in rows] == [
        ("2024-12-22", 136.7, 2.71, "Z-score", "Christmas peak"),
        ("2025-12-14", 134.3, 2.47, "IQR", "Christmas peak"),
        ("2025-12-21", 135.0, 2.54, "Z-score", "Christmas peak"),
    ]


def test_ranking(total):
    r = one(stats.ranking(total))
    names = ("current", "trend", "stability", "recovery", "peak", "consistency", "composite")
    assert tuple(r[n] for n in names) == (72.5, 36.5, 52.3, 26.2, 91.1, 48.7, 54.5)


def test_ensemble_forecast(total):
    rows = forecast.ensemble(total).orderBy("week_ahead").collect()
    assert [(r["forecast"], r["upper_95"], r["lower_95"]) for r in rows] == golden.FORECAST
    assert str(rows[0]["week_ending"]) == "2026-03-29"


def test_features(total):
    r = one(segment.features(total))
    names = (*segment.FEATURES, "yoy_change")
    assert tuple(r[n] for n in names) == golden.FEATURES["UK Total"][:9]


@pytest.fixture(scope="module")
def norm(spark):
    rows = [(k, *v[:9]) for k, v in golden.FEATURES.items()]
    schema = "series string, " + ", ".join(f"{f} double" for f in (*segment.FEATURES, "yoy_change"))
    return segment.normalise(spark.createDataFrame(rows, schema))


def test_clusters(norm):
    labelled, ks = segment.fit_clusters(norm, (3,), golden.SEEDS)
    assert list(ks) == [3]
    got = {r["series"]: (r["cluster_id"], r["cluster_name"]) for r in segment.name_clusters(labelled, 3).collect()}
    assert got == {k: (v[9], golden.NAMES[v[9]]) for k, v in golden.FEATURES.items()}
    assert round(by(segment.silhouette(labelled, [3]), "k")[3]["score"], 3) == 0.416


def test_profiles(norm):
    labelled, _ = segment.fit_clusters(norm, (3,), golden.SEEDS)
    r = by(segment.profiles(segment.name_clusters(labelled, 3)), "cluster_name")
    assert r["Stable Mid-Tier"]["mean_index"] == pytest.approx((110.24 + 111.01) / 2, abs=0.006)
    assert r["Stable Mid-Tier"]["top_feature"] == "christmas_peak"


def test_pca(norm):
    got = by(segment.pca(norm), "series")
    for j in (1, 2):
        sign = 1 if got["UK Total"][f"pc{j}"] * golden.PCA["UK Total"][j - 1] > 0 else -1
        for name, want in golden.PCA.items():
            assert got[name][f"pc{j}"] * sign == pytest.approx(want[j - 1], abs=1e-4)
    assert {r["cluster"] for r in got.values()} == {"Unknown"}
    shares = [r["explained_pct"] for r in segment.pca_variance(norm).orderBy("component").collect()]
    assert shares == [64.67, 27.68]


def test_components_add_up(total):
    parts = stats.decompose(total)
    gap = F.abs(F.col("observed") - F.col("trend") - F.col("seasonal") - F.col("residual"))
    assert parts.where(gap > 0.0151).count() == 0
