"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features of a text are its lower-cased letters with single spaces at word limits, cut into 1- to 3-grams and
hashed to ``BUCKETS`` buckets per length; a value is the share of the gram in the text times its inverse
document frequency, so a score needs one table lookup per gram and no vector per text.

Weights are fitted with follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties) on a
bounded sample: ``per_language`` different texts of each language, chosen by a hash of the text, so the sample does
not depend on partitioning. Each is used whole and as a short excerpt, so that one-line texts are known too.
A fifth of the sample is kept from the fit and sets the temperature that calibrates the probabilities.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if there was
nothing to learn from; repeated rows are scored one by one; an empty table gives an empty result; columns
other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import chunks, code_points, owners, utf8

#: Bytes of text a task works on at once.
CHUNK = 1 << 19
BUCKETS = 1 << 15
ORDERS = 3
UNUSED = ORDERS * BUCKETS
SCALE = 30.0
UNDETERMINED = "und"
EXCERPT = 48


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_buckets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each gram length the bucket at each place, the texts' offsets, and whether they have letters."""
    points, at = code_points(*utf8(pc.utf8_lower(pc.fill_null(texts, ""))))
    n = len(at) - 1
    padded = np.full(len(points) + 2 * n, 32, np.uint32)
    place = np.arange(len(points)) + 2 * owners(at) + 1
    letter = _letters()[points]
    padded[place] = np.where(letter, points, 32)
    offsets = at + 2 * np.arange(n + 1)
    is_letter = padded != 32
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[offsets[:-1]] = True
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    kept, offsets = padded[keep], before[offsets]
    found = []
    for order in range(1, ORDERS + 1):
        h = np.zeros(len(kept), np.uint32)
        for k in range(order):
            h[: len(kept) - k] = (h[: len(kept) - k] ^ kept[k:]) * np.uint32(0x9E3779B1)
        index = (h >> np.uint32(17)).astype(np.int32) + (order - 1) * BUCKETS
        for k in range(1, order):
            index[offsets[1:] - k] = UNUSED
        found.append(index)
    return found, offsets, np.diff(offsets) > 1


def _examples(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and shares of each text."""
    out = []
    for text in texts:
        grams, offsets, _ = gram_buckets(pa.array([text], pa.string()))
        index, count = np.unique(np.concatenate(grams), return_counts=True)
        use = index < UNUSED
        out.append((index[use], count[use] / max(1, offsets[-1])))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def ftrl(examples, labels: np.ndarray, classes: int, order: np.ndarray, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Weights per bucket and class, and a bias per class."""
    z = np.zeros((UNUSED + 1, classes))
    n = np.zeros((UNUSED + 1, classes))

    def current(rows):
        zr = z[rows]
        return -np.sign(zr) * np.maximum(np.abs(zr) - l1, 0) / ((beta + np.sqrt(n[rows])) / alpha + l2)

    for i in order:
        index, x = examples[i]
        rows, x = np.append(index, UNUSED), np.append(x, 1.0)
        w = current(rows)
        p = _softmax(x @ w)
        p[labels[i]] -= 1
        g = x[:, None] * p
        step = (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / alpha
        z[rows] += g - step * w
        n[rows] += g * g
    w = current(slice(None))
    return w[:UNUSED], w[UNUSED]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Divisor of the logits with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = _softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    lo, hi, r = -3.0, 3.0, (5**0.5 - 1) / 2
    a, b = hi - r * (hi - lo), lo + r * (hi - lo)
    for _ in range(40):
        if loss(a) < loss(b):
            hi, b = b, a
            a = hi - r * (hi - lo)
        else:
            lo, a = a, b
            b = lo + r * (hi - lo)
    return float(np.exp((lo + hi) / 2))


def fit_sample(texts: list[str], langs: list[str], epochs: int = 3, seed: int = 7) -> LanguageModel:
    """Fit on texts held in memory; they are put in a fixed order first."""
    pairs = sorted(zip(langs, texts, strict=True))
    names = tuple(sorted(set(langs)))
    label = {x: i for i, x in enumerate(names)}
    whole = [t for _, t in pairs]
    middle = [t[len(t) // 2 : len(t) // 2 + EXCERPT] for t in whole]
    examples = _examples(whole + middle)
    labels = np.array([label[x] for x, _ in pairs] * 2)
    rng = np.random.default_rng(seed)
    own = rng.permutation(len(pairs))
    test = own[: len(own) // 5]
    train = own[len(own) // 5 :]
    train, test = (np.concatenate([x, x + len(pairs)]) for x in (train, test))
    df = np.bincount(np.concatenate([examples[i][0] for i in train]), minlength=UNUSED)
    idf = np.log((1 + len(train)) / (1 + df)) + 1
    scaled = [(i, x * idf[i] * SCALE) for i, x in examples]
    order = np.concatenate([rng.permutation(train) for _ in range(epochs)])
    weights, bias = ftrl(scaled, labels, len(names), order)
    logits = np.array([x @ weights[i] + bias for i, x in (scaled[k] for k in test)]).reshape(-1, len(names))
    table = np.zeros((UNUSED + 1, len(names)), np.float32)
    table[:UNUSED] = weights * (idf * SCALE)[:, None]
    return LanguageModel(names, table, bias, _temperature(logits, labels[test]))


def labelled_sample(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 800
) -> tuple[list[str], DataFrame]:
    """All languages, and ``lang, text, key`` of at most ``per_language`` different texts of each.

    Texts are drawn by their own hash, so rows that repeat a text or an id count once. The share to draw follows the
    number of different texts, which a sketch counts; those least by hash stay, whatever that number was."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null"
    ).withColumn("key", F.xxhash64("text"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(1.3 * per_language / r["n"])).otherwise(share)
    place = F.pmod("key", F.lit(1 << 30)) / float(1 << 30)
    once = rows.where(place < share).groupBy("lang", "key").agg(F.min("text").alias("text"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 30)), "key"))
    drawn = once.withColumn("number", number).where(F.col("number") <= per_language)
    return sorted(r["lang"] for r in counts), drawn.select("lang", "text", "key")


def fit_language(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 per_language: int = 800) -> LanguageModel | None:
    """Model from rows with a text and a language; null if there are none.

    The fit runs in one task over ``labelled_sample``, which ``per_language`` bounds."""
    languages, drawn = labelled_sample(labelled, text_col, lang_col, per_language)
    if not languages:
        return None

    def fit(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("lang", pa.string()), ("text", pa.string())]))
        if table.num_rows:
            m = fit_sample(table.column("text").to_pylist(), table.column("lang").to_pylist())
            yield pa.RecordBatch.from_pylist(
                [{"langs": list(m.languages), "weights": m.weights.tobytes(), "bias": m.bias.tolist(),
                  "temperature": m.temperature}]
            )

    found = (
        drawn.repartition(1).sortWithinPartitions("lang", "key").select("lang", "text")
        .mapInArrow(fit, "langs array<string>, weights binary, bias array<double>, temperature double")
        .collect()
    )
    if not found:
        return LanguageModel(tuple(languages), np.zeros((UNUSED + 1, len(languages)), np.float32),
                             np.zeros(len(languages)), 1.0)
    m = found[0]
    weights = np.frombuffer(bytes(m["weights"]), np.float32).reshape(UNUSED + 1, -1)
    return LanguageModel(tuple(m["langs"]), weights, np.array(m["bias"]), m["temperature"])


def _predicted(texts: pa.Array, model: LanguageModel | None) -> tuple[np.ndarray, np.ndarray]:
    """Language and probability of each text."""
    if model is None:
        return np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
    grams, offsets, lettered = gram_buckets(texts)
    logits = np.zeros((len(texts), len(model.languages)))
    for index in grams:
        logits += np.add.reduceat(model.weights[index], offsets[:-1], axis=0)
    p = _softmax((logits / np.diff(offsets)[:, None] + model.bias) / model.temperature)
    best = np.array(model.languages, object)[p.argmax(axis=1)]
    return np.where(lettered, best, UNDETERMINED), np.where(lettered, p.max(axis=1), 0.0)


def score_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text",
                   id_col: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred`` and ``score`` (probability of the predicted language)."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))

    def score(batches):
        for part, _, _ in chunks(batches, "body", CHUNK):
            label, sure = _predicted(part.column("body"), model)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(label, pa.string()), pa.array(sure, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: LanguageModel | None, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is determined with probability ``least`` or more, unchanged; rows are
    filtered where they are read."""

    def run(batches):
        for part, _, _ in chunks(batches, text_col, CHUNK):
            label, sure = _predicted(part.column(text_col), model)
            yield part.filter(pa.array((label != UNDETERMINED) & (sure >= least)))

    return docs.mapInArrow(run, docs.schema)
