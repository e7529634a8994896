"""Behaviour that matters at scale: one scan per source, no one-task groups, exact block results."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom.functions.ranking import with_position, with_rank
from weekloom.operators import clean, segment, stats
from weekloom.plans import registry
from weekloom.sources import tables

from .frames import by, panel
from .plans import executed, final_part, source_rows_read

random.seed(7)

# one pass over the lines per panel kind a query uses
TWO_PANELS = {"an_summary", "an_report_facts"}
CHECKED = [
    "q01_latest", "q02_ranking", "q07_xmas", "q09_vs_total", "q15_dashboard", "v_summary", "dq_log",
    "etl_stats", "clean_interpolate", "tr_vs_total", "an_ranking", "an_corr", "an_site_welch",
    "an_summary", "an_report_facts", "fc_eval", "sg_normalised", "sg_profiles", "ch_ranking", "ch_forecast",
]


@pytest.mark.parametrize("name", CHECKED)
def test_lines_are_read_once(spark, folder, name):
    """Shared plans must end in reused exchanges or in a stored table, whatever columns each branch needs."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    _, last = source_rows_read(spark, "lineitem")
    registry.queries()[name](spark, folder).collect()
    read, _ = source_rows_read(spark, "lineitem", last)
    assert read == lines * (2 if name in TWO_PANELS else 1)


def test_no_cartesian_products(spark, folder):
    for name in ("an_site_welch", "tr_vs_total", "sg_normalised", "q15_dashboard"):
        plan = final_part(executed(registry.queries()[name](spark, folder)))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_reads_only_the_needed_columns(spark, folder):
    plan = executed(tables.region_weekly(spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_one_series_report_filters_before_the_line_join(spark, folder):
    plan = executed(registry.queries()["report_region"](spark, folder))
    assert f"EqualTo(n_name,{registry.ONE_SERIES})" in plan


def test_large_dimensions_are_not_broadcast(spark, folder):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    want = by(tables.region_weekly(spark, folder), "series", "week_ending")
    try:
        spark.conf.set(key, "1")
        df = tables.region_weekly(spark, folder)
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert by(df, "series", "week_ending") == want
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_the_window(spark, descending):
    values = [random.choice([None, 1.5, 1.504, 99.0, *[random.gauss(100, 20) for _ in range(3)]]) for _ in range(400)]
    df = spark.createDataFrame([(i, i % 3, v) for i, v in enumerate(values)], "id int, g int, v double")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    for group in ([], ["g"]):
        want = df.withColumn("w", F.rank().over(Window.partitionBy(*group).orderBy(order)).cast("bigint"))
        got = with_rank(df, "v", "r", by=group, descending=descending, digits=12)
        assert got.join(want, "id").where("r <> w or r is null").count() == 0
        assert got.count() == len(values)


def test_rank_moves_no_rows_to_a_single_task(spark):
    df = spark.range(1000).select("id", (F.col("id") * 0.37).alias("v"))
    plan = executed(with_rank(df, "v", "r"))
    # the only single-partition window runs over value buckets
    windows = [line for line in plan.splitlines() if "Window [" in line and "rank(" in line]
    assert not windows


def test_position_orders_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "series string, v double")
    got = by(with_position(df, "v", "series", "p"), "series")
    assert {k: r["p"] for k, r in got.items()} == {"c": 1, "a": 2, "b": 3}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows share one key; the map side must already collapse them."""
    df = spark.range(0, 90000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.lit("2024-01-07").alias("w"),
        F.col("id").alias("v"),
        F.col("id").alias("seq"),
    )
    got = clean.dedupe_first(df, ["k", "w"], ["seq"])
    assert "partial_min_by" in got._jdf.queryExecution().executedPlan().toString()
    assert by(got.where("k = 0"), "k")[0]["v"] == 0 and got.count() == 60001


def series_panel(spark, n: int, weeks: int = 30):
    base = np.random.default_rng(3).normal(100, 10, (n, weeks))
    rows = {f"s{i:02d}": list(base[i]) for i in range(n)}
    for i in range(0, n, 4):
        rows[f"s{i:02d}"][i % weeks] = None
    return panel(spark, **rows), rows


def test_correlation_does_not_depend_on_the_blocks(spark):
    p, rows = series_panel(spark, 13)
    one = by(stats.correlation(p), "a", "b")
    many = by(stats.correlation(p, block_rows=3), "a", "b")
    assert one == many and len(one) == 13 * 13
    for a, b in itertools.combinations(sorted(rows), 2):
        both = [(x, y) for x, y in zip(rows[a], rows[b]) if x is not None and y is not None]
        want = np.corrcoef(*zip(*both))[0, 1]
        assert one[a, b]["r"] == pytest.approx(want, abs=6e-4) == one[b, a]["r"]
    lower = by(stats.correlation_lower(p, block_rows=3), "a", "b")
    assert len(lower) == 13 * 14 // 2 and all(a >= b for a, b in lower)


def test_correlation_matrix_is_complete(spark):
    p = panel(spark, a=[1, 2, None, None], b=[None, None, 1, 2], c=[100, 100, 100, 100])
    got = {k: r["r"] for k, r in by(stats.correlation(p), "a", "b").items()}
    assert len(got) == 9 and got["a", "a"] == got["b", "b"] == 1.0
    assert all(got[k] is None for k in got if "c" in k or k in (("a", "b"), ("b", "a")))


@pytest.mark.parametrize("level", [1e0, 1e2, 1e4, 1e6, 1e8])
def test_correlation_keeps_its_digits_at_any_level(spark, level):
    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 1, (2, 60))
    p = panel(spark, a=list(level + x), b=list(level + y - 0.3 * x))
    got = by(stats.correlation(p), "a", "b")["a", "b"]["r"]
    wide = p.groupBy("week_ending").pivot("series", ["a", "b"]).agg(F.first("idx"))
    assert got == pytest.approx(wide.agg(F.corr("a", "b")).first()[0], abs=6e-4)


def test_welch_does_not_depend_on_the_blocks(spark):
    p, rows = series_panel(spark, 9)
    one = by(stats.welch(p), "a", "b")
    assert one == by(stats.welch(p, block_rows=2), "a", "b") and len(one) == 36
    x, y = (np.array([v for v in rows[k] if v is not None]) for k in ("s01", "s02"))
    ex, ey = x.var(ddof=1) / len(x), y.var(ddof=1) / len(y)
    assert one["s01", "s02"]["t_stat"] == pytest.approx((x.mean() - y.mean()) / np.sqrt(ex + ey), abs=6e-4)
    d = (x.mean() - y.mean()) / np.sqrt((x.var() + y.var()) / 2)
    assert one["s01", "s02"]["cohens_d"] == pytest.approx(d, abs=6e-4)


def test_p_values_against_closed_forms(spark):
    # one degree of freedom: 1 - 2/pi * atan(t); two: 1 - t / sqrt(2 + t^2)
    from weekloom.functions.student import t_two_sided

    rows = [(t, d) for t in (0.0, 0.3, 1.0, 4.0, 30.0) for d in (1.0, 2.0)]
    df = spark.createDataFrame(rows, "t double, d double")
    for r in df.select("t", "d", t_two_sided(F.col("t"), F.col("d")).alias("p")).collect():
        want = 1 - 2 / np.pi * np.arctan(r["t"]) if r["d"] == 1 else 1 - r["t"] / np.sqrt(2 + r["t"] ** 2)
        assert r["p"] == pytest.approx(want, abs=1e-8)
    # many degrees of freedom approach the normal distribution
    (r,) = spark.range(1).select(t_two_sided(F.lit(1.96), F.lit(1e6)).alias("p")).collect()
    assert r["p"] == pytest.approx(0.05, abs=1e-4)


def points(spark, n: int = 23):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 1, (n, 8)) + (np.arange(n) % 3)[:, None] * 3, 3)
    x[5] = x[2]  # a copy
    rows = [(f"s{i:02d}", [float(v) for v in x[i]], i % 2, i % 3) for i in range(n)]
    return x, spark.createDataFrame(rows, "series string, p array<double>, k2 int, k3 int")


def brute_silhouette(x, labels):
    scores = []
    for i, own in enumerate(labels):
        d = np.linalg.norm(x - x[i], axis=1)
        unequal = (x != x[i]).any(axis=1)
        near = d[(labels == own) & unequal]
        a = near.mean() if len(near) else 0.0
        b = min(d[labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b, 1e-8))
    return np.mean(scores)


@pytest.mark.parametrize("block_rows", [512, 4])
def test_silhouette_is_exact(spark, block_rows):
    x, df = points(spark)
    got = by(segment.silhouette(df, [2, 3], block_rows), "k")
    for k in (2, 3):
        assert got[k]["score"] == pytest.approx(brute_silhouette(x, np.arange(len(x)) % k), abs=1e-9)


def test_lloyd_equals_brute_force(spark):
    x, df = points(spark)
    start = {k: x[[0, 1, 4, 7][:k]] for k in (2, 3, 4)}
    labels = segment.lloyd(df, start)
    got = df.select("series", *[c.alias(f"c{k}") for k, c in labels.items()]).orderBy("series").collect()
    for k, c in start.items():
        c = c.copy()
        for _ in range(100):
            lab = np.argmin(np.linalg.norm(x[:, None] - c[None], axis=2), axis=1)
            new = np.array([x[lab == i].mean(axis=0) if (lab == i).any() else c[i] for i in range(k)])
            if np.allclose(c, new):
                break
            c = new
        assert [r[f"c{k}"] for r in got] == list(lab)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Tables where a third of all lines belong to one order and a third to one part."""
    out = str(tmp_path_factory.mktemp("skew"))
    n = 240000
    spark.range(8).selectExpr("cast(id as int) n_nationkey", "concat('N', id) n_name", "1 n_regionkey").write.parquet(f"{out}/nation.parquet")
    spark.range(500).selectExpr("id c_custkey", "cast(id % 8 as int) c_nationkey").write.parquet(f"{out}/customer.parquet")
    spark.range(40000).selectExpr("id o_orderkey", "id % 500 o_custkey").write.parquet(f"{out}/orders.parquet")
    spark.range(2000).selectExpr("id p_partkey", "concat('T', id % 3) p_type").write.parquet(f"{out}/part.parquet")
    spark.range(0, n, numPartitions=12).selectExpr(
        "if(id % 3 = 0, 7, id % 40000) l_orderkey",
        "if(id % 3 = 1, 11, id % 2000) l_partkey",
        "cast(id % 50 + 1 as double) l_quantity",
        "cast(date_add(date'1996-01-01', cast(id % 700 as int)) as timestamp_ntz) l_shipdate",
    ).write.parquet(f"{out}/lineitem.parquet")
    return out


def test_hot_join_keys_are_split(spark, skewed):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    frames = {"region": tables.region_weekly, "site": tables.site_weekly}
    want = {k: by(f(spark, skewed), "series", "week_ending") for k, f in frames.items()}
    old = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        for k, f in frames.items():
            df = f(spark, skewed)
            got = by(df, "series", "week_ending")
            assert got == want[k]
            assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    total = sum(r["qty"] for r in want["region"].values())
    assert total == sum(i % 50 + 1 for i in range(240000)) == sum(r["qty"] for r in want["site"].values())


@pytest.mark.parametrize("limit", ["64MB", "32m", "-1"])
def test_queries_run_at_any_broadcast_threshold(spark, folder, limit):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name, None)
    want = by(registry.queries()["q02_ranking"](spark, folder), "series")
    try:
        spark.conf.set(name, limit)
        assert by(registry.queries()["q02_ranking"](spark, folder), "series") == want
        assert registry.queries()["q10_site_winner"](spark, folder).count() > 0
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


@pytest.mark.parametrize("values", ["tied", "spread"])
def test_ranks_have_no_one_task_window(spark, values):
    n = 100_000
    v = F.lit(1.0) if values == "tied" else F.rand(seed=2) * 1e6
    df = spark.range(n, numPartitions=8).select(F.format_string("k%06d", "id").alias("series"), v.alias("v"))
    got = with_position(df, "v", "series", "place")
    plan = got._jdf.queryExecution().executedPlan().toString()
    got = got.orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, n + 1))
    assert all(a["v"] > b["v"] or a["v"] == b["v"] and a["series"] < b["series"] for a, b in itertools.pairwise(got))
    ranked = with_rank(df, "v", "r")
    for text in (plan, ranked._jdf.queryExecution().executedPlan().toString()):
        windows = [i for i, line in enumerate(text.split("\n")) if "Window [" in line]
        below = ["\n".join(text.split("\n")[i : i + 4]) for i in windows]
        assert not any("SinglePartition" in b for b in below)


def test_rank_buckets_are_even(spark):
    """Values crowd in one hundredth; buckets follow the values all the same."""
    df = spark.range(20_000).select((F.col("id") / 1e8).alias("v"), F.lit("g").alias("g"))
    got = by(with_rank(df, "v", "r", by=["g"], digits=9), "v")
    assert len(got) == 20_000 and {r["r"] for r in got.values()} == set(range(1, 20_001))


def test_stored_tables_need_a_shared_folder(spark, monkeypatch):
    from weekloom.sources import scratch

    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: None)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(Session())
    assert scratch.scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_more_than_four_segments_keep_their_names(spark):
    rng = np.random.default_rng(0)
    rows = [(f"s{i}", *map(float, rng.normal(20 * (i % 6), 0.1, 9)), i % 6) for i in range(30)]
    columns = ["series", *segment.FEATURES, "yoy_change", "k6"]
    df = segment.name_clusters(spark.createDataFrame(rows, columns), 6)
    assert df.select("cluster_id", "cluster_name").distinct().count() == 6
    assert segment.profiles(df).count() == 6


def test_unsettled_clusters_are_an_error(spark):
    x, df = points(spark)
    with pytest.raises(RuntimeError, match="settle"):
        segment.lloyd(df, {4: x[[0, 1, 4, 7]]}, max_iter=1)


def test_squared_silhouette_equals_brute_force(spark):
    x, df = points(spark)
    got = by(segment.squared_silhouette(df, [2, 3]), "k")
    for k in (2, 3):
        labels = np.arange(len(x)) % k
        d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        own = np.array([d[i, labels == labels[i]].sum() / (np.sum(labels == labels[i]) - 1) for i in range(len(x))])
        other = np.array([min(d[i, labels == c].mean() for c in set(labels) - {labels[i]}) for i in range(len(x))])
        assert got[k]["score"] == pytest.approx(np.mean((other - own) / np.maximum(own, other)), abs=1e-9)


def test_report_facts_cover_every_series(spark):
    p, rows = series_panel(spark, 9)
    facts = stats.report_facts(p, total="s00")
    assert facts.where("metric = 'series_latest'").count() == 9
    assert stats.report_facts(p, total="s00", first=2).where("metric = 'series_latest'").count() == 2


def test_p_values_at_published_points(spark):
    """Two-sided 5 % points of Student's t as printed in tables."""
    from weekloom.functions.student import t_two_sided

    table = {3: 3.182446, 4: 2.776445, 5: 2.570582, 6: 2.446912, 7: 2.364624, 8: 2.306004, 9: 2.262157, 10: 2.228139, 100: 1.983972}
    df = spark.createDataFrame([(t, float(d)) for d, t in table.items()], "t double, d double")
    for r in df.select(t_two_sided(F.col("t"), F.col("d")).alias("p")).collect():
        assert r["p"] == pytest.approx(0.05, abs=1e-6)


def test_consumed_year_on_year_is_not_sorted(spark, folder):
    plan = registry.queries()["al_impact"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan
