"""Quality classifier: ridge regression on random Fourier features of document statistics.

1. ``document_statistics``: some twenty ratios and logarithms of counts per whole text, in one pass.
2. Statistics are standardised with the mean and deviation of the training rows and mapped to
   ``cos(W x + b)``: with Gaussian ``W`` inner products of such vectors approximate a Gaussian kernel.
3. Every partition sums its part of the normal equations; the sums are added by matrix row and solved on the
   driver, whose size (features squared) does not depend on the data.
4. Isotonic calibration: labels of training rows kept from the fit are counted in fixed buckets of the raw
   score, pooled to a non-decreasing curve, and read by linear interpolation. A thousandth of the score is
   the raw score itself, which orders texts within a flat part of the curve.

All labelled rows are used; nothing is sampled. Defined results: null text counts as empty and gets a score
like any other; repeated labels of one document are averaged; without any label every score is 0.5; repeated
rows are scored one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .arrays import FOLDED_VALUES, PrefixHash, chunks, owners, words

STATISTICS = (
    "log_bytes", "log_words", "word_len", "log_longest", "upper", "digit", "symbol", "exclaim", "bar",
    "point", "line_ends", "non_ascii", "distinct_words", "same_as_previous", "capital_words",
    "marked_words", "repeated_windows", "repeated_lines", "words_per_line", "other",
)
_CLASSES = np.full(256, 8, np.int64)
_CLASSES[65:91] = 0
_CLASSES[97:123] = 9
_CLASSES[48:58] = 1
_CLASSES[[ord(c) for c in "#*$%&<>"]] = 2
_CLASSES[ord("!")] = 3
_CLASSES[ord("|")] = 4
_CLASSES[[ord(c) for c in ".,;:?'\"-()"]] = 5
_CLASSES[10] = 6
_CLASSES[[32, 9, 11, 12, 13]] = 10
_CLASSES[128:] = 7
_KINDS = 11


def _distinct(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Number of different values per owner."""
    key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    return np.bincount((key[first] >> np.uint64(40)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Matrix of ``STATISTICS`` for the texts of a chunk."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kinds = np.bincount(owners(offsets) * _KINDS + _CLASSES[data], minlength=n * _KINDS).reshape(n, _KINDS)
    starts, ends, at = words(data, offsets)
    count = np.diff(at)
    owner = owners(at)
    hashes = PrefixHash(data, FOLDED_VALUES)
    h = hashes.of(starts, ends)
    length = ends - starts
    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_CLASSES[data] == 0, out=upper[1:])
    lower = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_CLASSES[data] == 9, out=lower[1:])
    capital = (upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])
    marked = np.isin(_CLASSES[data[ends - 1]], (2, 3, 4)) if len(ends) else np.zeros(0, bool)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    three = np.flatnonzero(owner[2:] == owner[:-2]) if len(h) > 2 else np.zeros(0, np.int64)
    window = h[three] * np.uint64(3) + h[three + 1] * np.uint64(5) + h[three + 2] * np.uint64(7)
    windows = np.bincount(owner[three], minlength=n)
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))[: len(line_start)]
    line_owner = np.searchsorted(offsets, line_start, side="right") - 1
    full = line_end - line_start > 1
    lines = np.bincount(line_owner[full], minlength=n)
    trim = line_end - (data[line_end - 1] == 10) if len(line_end) else line_end
    different = _distinct(line_owner[full], hashes.of(line_start[full], trim[full]), n)

    def share(part, whole):
        return np.divide(part, whole, out=np.zeros(n), where=whole > 0)

    return np.column_stack(
        [
            np.log1p(size), np.log1p(count), share(np.bincount(owner, length, n), count), np.log1p(longest),
            *[share(kinds[:, k], size) for k in range(8)],
            share(_distinct(owner, h, n), count), share(np.bincount(owner[same], minlength=n), count),
            share(np.bincount(owner[capital], minlength=n), count),
            share(np.bincount(owner[marked], minlength=n), count),
            share(windows - _distinct(owner[three], window, n), windows), share(lines - different, lines),
            np.log1p(share(count, lines)), share(kinds[:, 8], size),
        ]
    ).astype(np.float32)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the array ``x`` of statistics."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for part, data, offsets in chunks(batches, "body"):
            x = statistics(data, offsets)
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(
                pa.list_(pa.float32())
            )
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), values], names=["doc_id", "x"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    return narrow.mapInArrow(run, f"doc_id {kind}, x array<float>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


@dataclass(frozen=True)
class FourierMap:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])


@dataclass(frozen=True)
class QualityModel:
    features: FourierMap
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return 0.999 * np.interp(raw, self.knots, self.heights) + 0.001 * np.clip(raw / 3 + 1 / 3, 0, 1)


def normal_equations(rows: DataFrame, features: FourierMap) -> np.ndarray:
    """``[Z'Z | Z'y]`` over rows ``x, y``, summed in each partition and then by matrix row."""

    def part(batches):
        total = 0.0
        for b in batches:
            if b.num_rows:
                z = features(matrix(b.column("x")))
                total = total + z.T @ np.column_stack([z, b.column("y").to_numpy()])
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                names=["i", "v"],
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "v": [np.sum(np.stack(pdf["v"]), axis=0)]})

    summed = rows.mapInArrow(part, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>")
    got = sorted(summed.collect())
    return np.array([r["v"] for r in got])


def pooled(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: centres and heights of the blocks."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, weight, strict=True):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit_quality(stats: DataFrame, labels: DataFrame, label_col: str = "quality", n_features: int = 256,
                ridge: float = 1e-3, seed: int = 11) -> QualityModel | None:
    """Model from statistics and labels (``doc_id`` and 0 or 1); null if they have no row in common.

    Every fifth training row, by a hash of its id, calibrates; the others fit."""
    y = labels.where(F.col(label_col).isNotNull()).groupBy("doc_id").agg(F.avg(label_col).alias("y"))
    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("calibrates")
    rows = stored(stats.join(y, "doc_id").select("x", "y", fold), "quality-train")
    moments = []
    for k in range(len(STATISTICS)):
        moments += [F.avg(F.col("x")[k]).alias(f"m{k}"), F.stddev_pop(F.col("x")[k]).alias(f"s{k}")]
    m = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("calibrates").alias("held"), *moments).first()
    if not m["n"]:
        return None
    d = len(STATISTICS)
    rng = np.random.default_rng(seed)
    scale = np.array([m[f"s{k}"] for k in range(d)])
    features = FourierMap(
        np.array([m[f"m{k}"] for k in range(d)]), np.where(scale > 1e-9, scale, 1.0),
        rng.normal(0, 1 / np.sqrt(d), (d, n_features)), rng.uniform(0, 2 * np.pi, n_features),
    )
    split = 0 < m["held"] < m["n"]
    fit_rows, own_rows = (rows.where("not calibrates"), rows.where("calibrates")) if split else (rows, rows)
    eq = normal_equations(fit_rows, features)
    a, b = eq[:, :-1], eq[:, -1]
    weights = np.linalg.solve(a + ridge * max(1.0, a[-1, -1]) * np.eye(len(a)) / n_features, b)
    raw_model = QualityModel(features, weights, np.zeros(1), np.zeros(1))

    def buckets(batches):
        for b in batches:
            raw = np.clip(raw_model.raw(matrix(b.column("x"))), -1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.floor(raw * 512).astype(np.int32)), b.column("y")], names=["bucket", "y"]
            )

    counted = sorted(
        own_rows.mapInArrow(buckets, "bucket int, y double").groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")).collect()
    )
    x = np.array([(r["bucket"] + 0.5) / 512 for r in counted])
    knots, heights = pooled(x, np.array([r["y"] for r in counted]), np.array([float(r["n"]) for r in counted]))
    return QualityModel(features, weights, knots, heights)


def score_quality(stats: DataFrame, model: QualityModel | None, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` (1 if the score reaches the threshold)."""
    kind = stats.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            s = model.score(matrix(b.column("x"))) if model is not None and b.num_rows else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_statistics(docs: DataFrame) -> DataFrame:
    """Statistics of all texts, stored: fit and scoring read them instead of the texts."""
    return stored(document_statistics(docs), "quality-statistics")
