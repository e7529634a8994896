"""Pairs left out by bounds, sampled starts, buckets, SQL table function."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.operators import segment, sqlpack, stats, transform
from weekloom.plans import registry
from weekloom.sources import writers

from .frames import by, weeks
from .plans import executed

PANEL = "series string, week_ending date, idx double"


def clustered(spark, seed: int, gaps: bool):
    """Six shapes with forty noisy series each; two of them run against each other."""
    rng = np.random.default_rng(seed)
    days = weeks("2020-01-05", 80)
    shapes = rng.normal(0, 1, (6, 80)).cumsum(axis=1)
    shapes[1] = -shapes[0]
    rows, matrix = [], {}
    for k in range(240):
        v = 100 + shapes[k % 6] * rng.uniform(1, 4) + rng.normal(0, 0.3 + 0.02 * (k // 6), 80)
        v = np.round(v, 3)
        if gaps and k % 17 == 0:
            v[rng.integers(0, 80, 5)] = np.nan
        if k == 100:
            v[:] = 5.0
        matrix[f"s{k:03d}"] = v
        rows += [(f"s{k:03d}", d, None if np.isnan(x) else float(x)) for d, x in zip(days, v, strict=True)]
    return spark.createDataFrame(rows, PANEL), matrix


def plain_extremes(matrix):
    found = []
    names = sorted(matrix)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            x, y = matrix[a], matrix[b]
            both = ~np.isnan(x) & ~np.isnan(y)
            x, y = x[both], y[both]
            if x.std() > 0 and y.std() > 0:
                found.append((float(np.rint(np.corrcoef(x, y)[0, 1] * 1000) / 1000 + 0.0), a, b))
    return {"most": max(found), "least": min(found)}


@pytest.mark.parametrize("gaps", [False, True])
def test_extremes_equal_all_pairs(spark, gaps):
    panel, matrix = clustered(spark, 3, gaps)
    want = plain_extremes(matrix)
    for block_rows in (16, 1024):
        got = {r.kind: (r.r, r.a, r.b) for r in stats.corr_extremes(panel, block_rows).collect()}
        assert got == want


def test_cells_are_left_out(spark):
    panel, matrix = clustered(spark, 5, False)
    want = plain_extremes(matrix)
    rows, table = stats._in_blocks(stats._angles(stats._vectors(panel), 80, stats.PIVOTS), 16)
    cells = stats.bounded_cells(table, want["most"][0], want["least"][0])
    kept, n, blocks = cells.where("kept").count(), cells.count(), table.count()
    assert n == blocks * (blocks - 1) // 2 and 0 < kept < n / 2
    inside = by(rows.groupBy("block").agg(F.collect_set("series").alias("s")), "block")
    pair = {b for b, r in inside.items() for x in want["least"][1:] if x in r["s"]}
    if len(pair) == 2:
        assert cells.where("kept").where(F.col("i") == min(pair)).where(F.col("j") == max(pair)).count() == 1


def test_sampled_start_finds_planted_groups(spark):
    """Two groups lie close together; the first points by hash put two starts into the far one and stay there."""
    rng = np.random.default_rng(1)
    names = sorted((f"s{i:04d}" for i in range(600)), key=lambda s: hashlib.md5(s.encode()).hexdigest())
    truth = {s: (0, 0, 1, *([0, 1, 2] * 199))[i] for i, s in enumerate(names)}
    centre = np.zeros((3, 8))
    centre[1:, 0] = 100, 106
    rows = [(s, [float(v) for v in rng.normal(centre[truth[s]], 0.5)]) for s in names]
    points = spark.createDataFrame(rows, "series string, p array<double>")

    def groups(start):
        label = segment.lloyd(points, start)[3]
        return {(truth[r["series"]], r["c"]) for r in points.select("series", label.alias("c")).collect()}

    assert len(groups(segment.sampled_centroids(points, [3]))) == 3
    assert len(groups(segment.start_centroids(points, [3]))) > 3
    assert {k: c.shape for k, c in segment.sampled_centroids(points, [2, 3]).items()} == {2: (2, 8), 3: (3, 8)}
    few = points.limit(2)
    assert list(segment.sampled_centroids(few, [2, 3, 4])) == []


def test_windows_on_buckets_need_no_exchange(spark, tmp_path):
    panel, _ = clustered(spark, 7, False)
    table = writers.save_bucketed(panel, str(tmp_path / "panel"), "panel_in_buckets", 6)
    plan = executed(transform.rolling(table, 4, 12))
    assert "Exchange" not in plan
    want = by(transform.rolling(panel, 4, 12), "series", "week_ending")
    assert by(transform.rolling(table, 4, 12), "series", "week_ending") == want
    spark.sql("DROP TABLE panel_in_buckets")


def test_report_is_callable_from_sql(spark, folder):
    df = registry.queries()["report_sql"](spark, folder)
    want = registry.queries()["report_region"](spark, folder)
    assert df.schema.names == want.schema.names and df.collect() == want.collect()
    assert f"EqualTo(n_name,{registry.ONE_SERIES})" in executed(df)
    joined = spark.sql("SELECT w.id, r.total_weeks FROM (SELECT 1 AS id) w, series_report(wanted => 'NATION_3') r")
    assert joined.count() == 1
    assert spark.sql("SELECT * FROM series_report('nowhere')").count() == 0


def test_report_quotes_names(spark):
    rows = [("it's; DROP", d, 100.0 + k) for k, d in enumerate(weeks("2024-01-07", 5))]
    sqlpack.register_report(transform.fact(spark.createDataFrame(rows, PANEL)), "own_report", "own_fact")
    got = spark.sql("SELECT * FROM own_report(wanted => :w)", args={"w": "it's; DROP"}).first()
    assert (got.series, got.total_weeks, got.mean_index) == ("it's; DROP", 5, 102.0)
