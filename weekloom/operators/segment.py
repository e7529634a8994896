"""Feature matrix, normalisation, k-means with silhouette choice, profiles and PCA."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import grid
from ..functions.numeric import age, position, rnd
from ..sources.scratch import stored

FEATURES = (
    "mean_index",
    "std_index",
    "trend_slope",
    "seasonal_amplitude",
    "christmas_peak",
    "january_trough",
    "recovery_rate",
    "current_index",
)
# Segment names, best mean first. Further segments are called by their number.
NAMES = ("High-Performance Metros", "Stable Mid-Tier", "Recovering Regions", "Emerging Regions")


def segment_name(place: int) -> str:
    """Name of the segment with the ``place``-th best mean, from 0."""
    return NAMES[place] if place < len(NAMES) else f"Segment {place + 1}"


def features(panel: DataFrame) -> DataFrame:
    """Nine features per series from one aggregation."""
    v, month = F.col("idx"), F.month("week_ending")
    rows = panel.where(v.isNotNull()).withColumns({"x": position().cast("double"), "age": age()})
    per = rows.groupBy("series").agg(
        F.avg(v).alias("m"),
        F.stddev_pop(v).alias("sd"),
        F.coalesce(F.regr_slope(v, F.col("x")), F.lit(0.0)).alias("slope"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.avg(F.when(month == 12, v)).alias("dec"),
        F.avg(F.when(month == 1, v)).alias("jan"),
        F.max(F.when(F.col("age") == 1, v)).alias("last"),
        F.max(F.when(F.col("age") == 53, v)).alias("then"),
    )
    c = F.col
    return per.select(
        "series",
        rnd("m", 2).alias("mean_index"),
        rnd("sd", 2).alias("std_index"),
        rnd("slope", 4).alias("trend_slope"),
        rnd(c("hi") - c("lo"), 2).alias("seasonal_amplitude"),
        F.coalesce(rnd("dec", 2), c("m")).alias("christmas_peak"),
        F.coalesce(rnd("jan", 2), c("m")).alias("january_trough"),
        rnd((c("last") - c("lo")) / (c("hi") - c("lo") + 0.01), 3).alias("recovery_rate"),
        rnd("last", 2).alias("current_index"),
        rnd(F.coalesce(c("last") - c("then"), F.lit(0.0)), 2).alias("yoy_change"),
    )


def z(name: str) -> str:
    return f"z_{name}"


def normalise(feats: DataFrame) -> DataFrame:
    """Features plus ``z_*`` columns: population z-scores over all series."""
    moments = [F.avg(f).alias(f"m_{f}") for f in FEATURES] + [
        F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES
    ]
    whole = feats.agg(F.struct(*moments)).scalar()
    return (
        feats.withColumn("_w", whole)
        .withColumns(
            {
                z(f): (F.col(f) - F.col(f"_w.m_{f}")) / (F.col(f"_w.s_{f}") + F.lit(1e-8))
                for f in FEATURES
            }
        )
        .drop("_w")
    )


POINT = f"array({', '.join(z(f) for f in FEATURES)})"


def _nearest(centroids: np.ndarray) -> str:
    """SQL for the index of the centroid nearest to the array ``p``, the first among equals. Centroids
    enter as one array constant, so every iteration runs the same compiled code."""
    rows = ", ".join("array(" + ", ".join(f"{float(x)!r}D" for x in c) + ")" for c in centroids)
    squares = "zip_with(p, c, (x, y) -> (x - y) * (x - y))"
    far = f"sqrt(aggregate({squares}, 0D, (s, x) -> s + x))"
    return f"array_min(transform(array({rows}), (c, i) -> struct({far} as far, i as i))).i"


def lloyd(
    points: DataFrame, start: Mapping[int, np.ndarray], max_iter: int = 300
) -> dict[int, Column]:
    """Run k-means from the start centroids of every k in the same jobs; returns the label per k.

    ``points`` has the coordinates in an array ``p``. A pass aggregates k * 8 means with map-side
    combine; only the centroids come back. An empty cluster keeps its centroid. Labels belong to the
    centroids before the last, immaterial move. Centroids that still move after ``max_iter`` passes are an
    error, not a result."""
    centroids = {k: np.array(c, dtype=float) for k, c in start.items()}
    moving = set(centroids)
    dims = [f"avg(p[{i}]) as x{i}" for i in range(len(FEATURES))]
    for _ in range(max_iter):
        if not moving:
            break
        labels = ", ".join(f"struct({k} as k, {_nearest(centroids[k])} as c)" for k in sorted(moving))
        means = (
            points.selectExpr(f"explode(array({labels})) as l", "p")
            .groupBy("l.k", "l.c")
            .agg(*map(F.expr, dims))
            .collect()
        )
        moved = {k: centroids[k].copy() for k in moving}
        for r in means:
            moved[r["k"]][r["c"]] = [r[f"x{i}"] for i in range(len(FEATURES))]
        for k in list(moving):
            if np.allclose(centroids[k], moved[k]):
                moving.discard(k)
            else:
                centroids[k] = moved[k]
    if moving:
        raise RuntimeError(f"k-means did not settle within {max_iter} passes for k in {sorted(moving)}")
    return {k: F.expr(_nearest(c)) for k, c in centroids.items()}


def start_centroids(
    points: DataFrame, ks: Sequence[int], seeds: Mapping[int, Sequence[str]] | None = None
) -> dict[int, np.ndarray]:
    """Start centroids for every k below the number of points: the given series, or the first k in
    the order of a hash of the key, which is random but the same on every run."""
    rows = points.select("series", "p")
    if seeds is None:
        rows = rows.orderBy(F.md5("series"), "series").limit(max(ks) + 1)
    else:
        rows = rows.where(F.col("series").isin(sorted({s for k in ks for s in seeds[k]})))
    found = rows.collect()
    at = {r["series"]: r["p"] for r in found}
    if seeds is not None:
        return {k: np.array([at[s] for s in seeds[k]]) for k in ks}
    return {k: np.array(list(at.values())[:k]) for k in ks if k < len(found)}


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def _weighted_start(x: np.ndarray, weight: np.ndarray, k: int, passes: int = 50) -> np.ndarray:
    """k centres of a few weighted candidates: the heaviest, then always the one that costs most, then Lloyd's steps."""
    centres = x[[int(np.argmax(weight))]]
    while len(centres) < k:
        cost = weight * _apart(x, centres).min(axis=1)
        centres = np.vstack([centres, x[int(np.argmax(cost))]])
    for _ in range(passes):
        near = _apart(x, centres).argmin(axis=1)
        moved = np.array([
            np.average(x[near == c], axis=0, weights=weight[near == c]) if (near == c).any() else centres[c] for c in range(k)
        ])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def sampled_centroids(points: DataFrame, ks: Sequence[int], passes: int = 5, oversample: float = 4.0) -> dict[int, np.ndarray]:
    """Start centroids by k-means||: each pass draws points with a chance that grows with their squared distance from
    the candidates so far, about ``oversample * max(ks)`` a pass; the candidates, weighted by the points nearest
    to them, are clustered on the driver. Draws are hashes of key and pass, so a run is repeatable. Only the
    candidates leave the tasks: a few dozen, however many points there are."""
    rows = points.select("series", "p")
    first = rows.orderBy(F.md5("series"), "series").limit(max(ks) + 1).collect()
    usable = [k for k in ks if k < len(first)]
    if not usable:
        return {}
    candidates = np.array([first[0]["p"]], dtype=float)

    def cost(c: np.ndarray) -> Column:
        listed = ", ".join("array(" + ", ".join(f"{float(v)!r}D" for v in row) + ")" for row in c)
        squares = "aggregate(zip_with(p, c, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"
        return F.expr(f"array_min(transform(array({listed}), c -> {squares}))")

    for i in range(passes):
        far = rows.withColumn("_d", cost(candidates))
        total = far.agg(F.sum("_d")).first()[0]
        if not total:
            break
        draw = F.pmod(F.xxhash64("series", F.lit(i)), F.lit(1 << 40)) / float(1 << 40)
        chance = F.col("_d") * float(oversample * max(usable) / total)
        found = [r["p"] for r in far.where(draw < chance).select("p").collect()]
        if found:
            candidates = np.unique(np.vstack([candidates, np.array(found, dtype=float)]), axis=0)
    # fewer candidates than centres: fill up with the first points
    extra = [r["p"] for r in first if not (np.abs(candidates - np.array(r["p"])) < 1e-12).all(axis=1).any()]
    if len(candidates) < max(usable) and extra:
        candidates = np.vstack([candidates, np.array(extra, dtype=float)])
    near = dict(rows.select(F.expr(_nearest(candidates)).alias("c")).groupBy("c").count().collect())
    weight = np.array([near.get(c, 0) for c in range(len(candidates))], dtype=float)
    return {k: _weighted_start(candidates, weight, min(k, len(candidates))) for k in usable}


def fit_clusters(
    norm: DataFrame,
    ks: Sequence[int] = (2, 3, 4),
    seeds: Mapping[int, Sequence[str]] | None = None,
    max_iter: int = 300,
    sampled: bool = False,
) -> tuple[DataFrame, Sequence[int]]:
    """Stored points with a label column ``k<k>`` for each usable k (k below the point count). The start is the given
    series, else the first ones by hash, or with ``sampled`` the centres of k-means||."""
    points = stored(norm, "points").withColumn("p", F.expr(POINT))
    start = sampled_centroids(points, ks) if sampled and seeds is None else start_centroids(points, ks, seeds)
    if not start:
        raise ValueError("clustering needs more series than clusters")
    labels = lloyd(points, start, max_iter)
    return points.withColumns({f"k{k}": c for k, c in labels.items()}), sorted(labels)


def _cell_distances(ks: Sequence[int]):
    """Per cell: summed distance and number of unequal points, per point and cluster of the others."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if not (left.empty or right.empty):
            a = np.stack(left["p"].to_numpy())
            b = np.stack(right["p"].to_numpy())
            d = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
            unequal = (a[:, None, :] != b[None, :, :]).any(axis=2)
            sides = [(left, right, d, unequal)]
            if left["cell_i"].iloc[0] != left["cell_j"].iloc[0]:
                sides.append((right, left, d.T, unequal.T))
            for own, other, dist, diff in sides:
                for k in ks:
                    to = other[f"k{k}"].to_numpy()
                    for c in np.unique(to):
                        parts.append(
                            pd.DataFrame(
                                {
                                    "k": k,
                                    "series": own["series"],
                                    "own": own[f"k{k}"],
                                    "other": int(c),
                                    "dist": dist[:, to == c].sum(axis=1),
                                    "unequal": diff[:, to == c].sum(axis=1),
                                    "n": int((to == c).sum()),
                                }
                            )
                        )
        columns = ["k", "series", "own", "other", "dist", "unequal", "n"]
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in columns})

    return run


def silhouette(labelled: DataFrame, ks: Sequence[int], block_rows: int = 512) -> DataFrame:
    """Exact mean Euclidean silhouette per k, as ``k, score``.

    ``labelled`` has ``series``, coordinates ``p`` and a label column ``k<k>`` per k. Distances are
    computed inside the cells of the block grid and leave a task as sums per point and cluster, so
    pairs are never rows. Copies of a point do not count as its neighbours."""
    points = labelled.select("series", "p", *[f"k{k}" for k in ks])
    left, right = grid(points, "series", "p", block_rows)
    cells = left.groupBy("cell_i", "cell_j").cogroup(right.groupBy("cell_i", "cell_j"))
    sums = cells.applyInPandas(
        _cell_distances(ks),
        "k int, series string, own int, other int, dist double, unequal long, n long",
    )
    per = sums.groupBy("k", "series", "own", "other").agg(
        F.sum("dist").alias("dist"), F.sum("unequal").alias("unequal"), F.sum("n").alias("n")
    )
    inside = F.col("own") == F.col("other")
    ab = per.groupBy("k", "series").agg(
        F.coalesce(
            F.max(F.when(inside & (F.col("unequal") > 0), F.col("dist") / F.col("unequal"))), F.lit(0.0)
        ).alias("a"),
        F.min(F.when(~inside, F.col("dist") / F.col("n"))).alias("b"),
    )
    score = (F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-8))
    # one cluster only: b is null everywhere and the score is -1
    return ab.groupBy("k").agg(F.coalesce(F.avg(score), F.lit(-1.0)).alias("score"))


def squared_silhouette(labelled: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Mean silhouette per k with squared Euclidean distances, in one linear pass.

    The sum of squared distances from a point to a cluster follows from the cluster's size, coordinate sums
    and sum of squared norms, so no pair of points is formed. A point alone in its cluster has distance 0."""
    size = len(FEATURES)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("c")) for k in ks]))
    rows = labelled.select("series", "p", each.alias("l")).select("series", "p", "l.k", "l.c")
    norm = F.aggregate("p", F.lit(0.0), lambda s, x: s + x * x)
    clusters = rows.groupBy("k", "c").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(norm).alias("q"),
        F.array(*[F.sum(F.col("p")[i]) for i in range(size)]).alias("s"),
    )
    listed = clusters.groupBy("k").agg(F.collect_list(F.struct("c", "n", "q", "s")).alias("of")).select(
        F.col("k").alias("k2"), "of"
    )
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    far = rows.join(listed, F.col("k") == F.col("k2")).select(
        "k", "c",
        F.transform(
            "of",
            lambda o: F.struct(
                o["c"].alias("c"), o["n"].alias("n"),
                F.greatest(F.lit(0.0), o["n"] * norm - 2 * dot(F.col("p"), o["s"]) + o["q"]).alias("d"),
            ),
        ).alias("of"),
    )
    own = F.filter("of", lambda o: o["c"] == F.col("c"))[0]
    others = F.transform(F.filter("of", lambda o: o["c"] != F.col("c")), lambda o: o["d"] / o["n"])
    ab = far.select(
        "k", F.when(own["n"] > 1, own["d"] / (own["n"] - 1)).otherwise(0.0).alias("a"), F.array_min(others).alias("b")
    )
    score = (F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-8))
    return ab.groupBy("k").agg(F.coalesce(F.avg(score), F.lit(-1.0)).alias("score"))


def best_k(scores: DataFrame) -> int:
    """The k with the highest silhouette; the smaller one among equals."""
    rows = sorted(scores.collect(), key=lambda r: r["k"])
    return max(rows, key=lambda r: r["score"])["k"]


def name_clusters(labelled: DataFrame, k: int) -> DataFrame:
    """Attach ``cluster_id`` and a name by descending mean index of the cluster."""
    df = labelled.withColumn("cluster_id", F.col(f"k{k}"))
    means = df.groupBy("cluster_id").agg(F.avg("mean_index").alias("m")).collect()
    order = [r["cluster_id"] for r in sorted(means, key=lambda r: (-r["m"], r["cluster_id"]))]
    name = F.lit("Unknown")
    for place, c in enumerate(order):
        name = F.when(F.col("cluster_id") == c, segment_name(place)).otherwise(name)
    return df.withColumn("cluster_id", F.col("cluster_id").cast("bigint")).withColumn(
        "cluster_name", name
    )


def cluster(
    norm: DataFrame,
    ks: Sequence[int] = (2, 3, 4),
    seeds: Mapping[int, Sequence[str]] | None = None,
    scores: Callable[[DataFrame, Sequence[int]], DataFrame] = silhouette,
    sampled: bool = False,
) -> DataFrame:
    """All features with ``cluster_id`` and ``cluster_name`` for the k the silhouette prefers. ``scores`` is the
    caller's choice: ``silhouette`` (exact Euclidean, quadratic in the series) or ``squared_silhouette``."""
    labelled, usable = fit_clusters(norm, ks, seeds, sampled=sampled)
    k = best_k(scores(labelled, usable)) if len(usable) > 1 else usable[0]
    return name_clusters(labelled, k)


def profiles(clustered: DataFrame) -> DataFrame:
    """Feature means per cluster and the feature with the largest one."""
    per = clustered.groupBy("cluster_id", "cluster_name").agg(*[rnd(F.avg(f), 2).alias(f) for f in FEATURES])
    per = per.drop("cluster_id")
    top = F.lit(FEATURES[-1])
    best = F.greatest(*FEATURES)
    for f in reversed(FEATURES):
        top = F.when(F.col(f) == best, f).otherwise(top)
    return per.withColumn("top_feature", top)


def _fit_pca(points: DataFrame, k: int):
    """Principal axes of the normalised features; the largest loading of an axis is positive."""
    vectors = VectorAssembler(inputCols=[z(f) for f in FEATURES], outputCol="v").transform(points)
    model = PCA(k=k, inputCol="v", outputCol="pc").fit(vectors)
    axes = model.pc.toArray()
    signs = [float(np.sign(axes[np.abs(axes[:, j]).argmax(), j])) for j in range(k)]
    return model, vectors, signs


def pca(points: DataFrame, k: int = 2) -> DataFrame:
    """Coordinates ``pc1..pck`` per series with its cluster ("Unknown" if not clustered)."""
    model, vectors, signs = _fit_pca(points, k)
    arr = vector_to_array("pc")
    name = F.col("cluster_name") if "cluster_name" in points.columns else F.lit("Unknown")
    return model.transform(vectors).select(
        "series",
        *[rnd(arr[j] * F.lit(s), 4).alias(f"pc{j + 1}") for j, s in enumerate(signs)],
        name.alias("cluster"),
    )


def pca_variance(points: DataFrame, k: int = 2) -> DataFrame:
    """Share of variance each component explains, in percent."""
    model, _, _ = _fit_pca(points, k)
    share = [float(x) * 100 for x in model.explainedVariance.toArray()]
    rows = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("component"), F.lit(x).alias("x"))
            for i, x in enumerate(share, 1)
        ]
    )
    return points.agg(F.count(F.lit(1)).alias("n_series")).select(
        F.explode(rows).alias("r"), "n_series"
    ).select("r.component", rnd("r.x", 2).alias("explained_pct"), "n_series")
