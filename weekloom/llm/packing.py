"""Best-fit packing of token sequences through a configuration linear program.

Pieces are at most ``capacity`` tokens long, so the packing problem is a histogram of at most ``capacity``
counts, whatever the number of texts. On it, with configurations (multisets of lengths that fit) as columns:

1. Multiplicative weights: a length's price is its size, lowered exponentially as it gets covered. A table is
   priced for the least covered lengths: knapsack dynamic programming over the capacity gives the most valuable
   content for every room, and each of the longer ones becomes a configuration with it. It gets as much as covers
   no length by more than a step. Tables are priced until ``TARGET`` of the demand's volume is covered.
2. Rounding: amounts are rounded down, full configurations only. What is left is solved again by the same pricing in
   whole multiples; prices that rise faster than the size keep short pieces for the end.
3. The small rest is placed by best fit, decreasing, on counts: one step places all pieces of a length that go
   to bins with the same contents.

Prices are also a lower bound: no configuration is worth more than the knapsack's best value, so the value of all
pieces, over that, cannot be packed into fewer sequences. The plan returns the best such bound.

The plan is a list of (configuration, multiplicity). Pieces are numbered within their length, salted so that
no length is one group, and read their sequence and offset from the plan: no piece moves between lengths.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .arrays import chunks
from .tokens import bpe, texts

CAPACITY = 2048


#: Part of the volume that fractional and that whole configurations cover before what is left goes on.
TARGET, WHOLE_TARGET = 0.97, 0.955
#: Lengths of a table that fill room, and longer ones that are completed with them.
FILLERS, FORCED = 100, 40
#: Power of the size in the prices of whole configurations.
GROWTH = 1.2
_NONE = 1e-9


class Knapsack:
    """Most valuable content, of each item once at most, for every room up to the capacity."""

    def __init__(self, items: np.ndarray, prices: np.ndarray, capacity: int):
        self.items = items.tolist()
        self.best = np.zeros(capacity + 1)
        self.taken = np.zeros((len(items), capacity + 1), bool)
        for i, (l, p) in enumerate(zip(self.items, prices.tolist(), strict=True)):
            more = self.best[: capacity + 1 - l] + p
            better = more > self.best[l:] + 1e-15
            self.taken[i, l:] = better
            self.best[l:] = np.where(better, more, self.best[l:])

    def content(self, room: int) -> list[int]:
        out = []
        for i in range(len(self.items) - 1, -1, -1):
            if self.taken[i, room]:
                out.append(self.items[i])
                room -= out[-1]
        return out


def best_value(prices: np.ndarray, capacity: int) -> float:
    """Value of the most valuable configuration, lengths used any number of times; ``prices[l]``: of length ``l``."""
    lengths = np.flatnonzero(prices > 0)
    best = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        fits = lengths[: np.searchsorted(lengths, c, side="right")]
        best[c] = max(best[c - 1], (best[c - fits] + prices[fits]).max(initial=0.0))
    return float(best[capacity])


def lower_bound(demand: np.ndarray, capacity: int, prices: list[np.ndarray]) -> int:
    """Sequences that any packing needs: by the sizes, by pieces of which no two fit together once those shorter than
    some limit are left out, and by the given prices."""
    size = np.arange(capacity + 1) / capacity
    found = [float((demand * size).sum())]
    for limit in np.flatnonzero(demand[: capacity // 2 + 1]).tolist() + [capacity // 2 + 1]:
        alone = demand[capacity - limit + 1 :].sum()
        found.append(float(alone + (demand * size)[limit : capacity - limit + 1].sum()))
    for price in prices:
        top = best_value(price, capacity)
        if top > 0:
            found.append(float((demand * price).sum() / top))
    return int(np.ceil(max(found) - 1e-6))


def configurations(
    demand: np.ndarray, capacity: int, whole: bool, target: float, step: float = 0.25, eta: float = 0.3, seed: int = 0
) -> tuple[dict[tuple, float], np.ndarray]:
    """Amounts of configurations that cover ``target`` of the demand's volume, and the last prices.

    With ``whole`` amounts are whole, of full configurations as long as there are any. Ends too when a run of tables
    gives none."""
    rng = np.random.default_rng(seed)
    every = np.flatnonzero(demand)
    size = np.arange(capacity + 1) / capacity
    value = size**GROWTH if whole else size
    volume = (demand * size).sum()
    covered = np.zeros(capacity + 1)
    amounts: dict[tuple, float] = {}
    jitter = 1.0 if whole else step
    idle = 0
    while idle <= 25:
        wanted = every[covered[every] < 1 - _NONE]
        missing = (demand[wanted] * size[wanted] * (1 - covered[wanted])).sum()
        if not len(wanted) or missing <= (1 - target) * volume:
            break
        order = np.argsort(covered[wanted] + rng.random(len(wanted)) * jitter, kind="stable")
        chosen = np.sort(wanted[order[: FILLERS + FORCED]])[::-1]
        cut = min(FORCED, len(chosen) // 3 + 1)
        long, items = chosen[:cut], chosen[cut:] if len(chosen) > cut else chosen
        items = rng.permutation(np.concatenate([items, items[items <= capacity // 2]]))
        price = value[items] * np.exp(-eta * (covered[items] - covered[wanted].min()))
        table = Knapsack(items, price, capacity)
        room = np.zeros(capacity + 1)
        room[chosen] = np.minimum(1.0 if whole else step, 1 - covered[chosen])
        done = 0
        for l in long.tolist():
            config = [l, *table.content(capacity - l)]
            if whole and sum(config) < capacity and idle < 15:
                continue  # later on it only goes out of the way: what is not full is not accepted
            use, times = np.unique(config, return_counts=True)
            for _ in range(3):
                amount = (room[use] * demand[use] / times).min()
                amount = np.floor(amount + 1e-6) if whole else amount
                if amount <= _NONE:
                    break
                key = tuple(sorted(config, reverse=True))
                amounts[key] = amounts.get(key, 0.0) + amount
                got = amount * times / demand[use]
                covered[use] += got
                room[use] -= got
                done += 1
        idle = 0 if done else idle + 1
    return amounts, np.where(demand > 0, size * np.exp(-eta * covered), 0.0)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Best fit, decreasing, on counts: contents and number of bins."""
    open_bins: dict[int, list[list]] = {}
    closed = []
    for l in sorted(counts, reverse=True):
        n = counts[l]
        while n:
            room = min((r for r in open_bins if r >= l), default=None)
            if room is None:
                each = min(capacity // l, n)
                full, n = n // each, n % each
                target, content = full, (l,) * each
                left = capacity - l * each
            else:
                have = open_bins[room][-1]
                target = min(n, have[1])
                n -= target
                content, left = (*have[0], l), room - l
                have[1] -= target
                if not have[1]:
                    open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
            if left:
                open_bins.setdefault(left, []).append([content, target])
            else:
                closed.append((content, target))
    return closed + [(c, k) for group in open_bins.values() for c, k in group]


class Plan(NamedTuple):
    """``bins``: configurations and multiplicities that hold exactly the pieces of a histogram. ``bound``: sequences that
    any packing needs. ``programmed``: pieces shorter than the capacity in configurations of the program; the
    other ones were placed by best fit."""

    bins: list[tuple[tuple, int]]
    bound: int
    programmed: int


def _accept(amounts: dict[tuple, float], left: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Full configurations, rounded down, the largest amounts first; takes their pieces out of ``left``."""
    out = []
    for config, amount in sorted(amounts.items(), key=lambda x: (-x[1], x[0])):
        if sum(config) < capacity:
            continue
        use, times = (x.tolist() for x in np.unique(config, return_counts=True))
        k = min(int(amount + 1e-6), *(left.get(u, 0) // n for u, n in zip(use, times, strict=True)))
        if k > 0:
            out.append((config, k))
            for u, n in zip(use, times, strict=True):
                left[u] -= k * n
    return out


def _demand(left: dict[int, int], capacity: int) -> np.ndarray:
    demand = np.zeros(capacity + 1)
    for l, n in left.items():
        demand[l] = n
    return demand


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """A packing of the pieces of a histogram of lengths from 1 to ``capacity``."""
    left = dict(sorted((l, n) for l, n in histogram.items() if n))
    bins = [((l,), left.pop(l)) for l in [capacity] if l in left]
    if not left:
        return Plan(bins, sum(k for _, k in bins), 0)
    demand = _demand(left, capacity)
    amounts, prices = configurations(demand, capacity, False, TARGET)
    bound = lower_bound(demand, capacity, [prices]) + sum(k for _, k in bins)
    placed = _accept(amounts, left, capacity)
    volume, rest = ((x * np.arange(capacity + 1)).sum() for x in (demand, _demand(left, capacity)))
    if rest:
        again, _ = configurations(_demand(left, capacity), capacity, True, 1 - (1 - WHOLE_TARGET) * volume / rest, seed=1)
        placed += _accept(again, left, capacity)
    programmed = sum(k * len(c) for c, k in placed)
    return Plan(bins + placed + best_fit({l: n for l, n in left.items() if n}, capacity), bound, programmed)


class Places:
    """Sequence and offset of the r-th piece of a length."""

    def __init__(self, configs: list[tuple[tuple, int]]):
        slots: dict[int, list[tuple[int, int, int]]] = {}
        sizes: dict[int, int] = {}
        base = 0
        for config, k in configs:
            offset = 0
            for l in config:
                slots.setdefault(l, []).append((sizes.get(l, 0), base, offset))
                sizes[l] = sizes.get(l, 0) + k
                offset += l
            base += k
        self.slots = {l: np.array(s, np.int64).T for l, s in slots.items()}

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for l in np.unique(length):
            own = np.flatnonzero(length == l)
            first, base, at = self.slots[int(l)]
            k = np.searchsorted(first, rank[own], side="right") - 1
            sequence[own], offset[own] = base[k] + rank[own] - first[k], at[k]
        return sequence, offset


def token_pieces(docs: DataFrame, files: tuple[str, str], end_id: int = 0, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and ``end_id``, cut from the end
    into pieces of ``capacity``, so that only the first may be shorter."""
    kind = docs.schema[id_col].dataType.simpleString()
    tail = int(end_id).to_bytes(4, "little")

    def run(batches):
        encode = bpe(*files)
        for part, _, _ in chunks(batches, "body"):
            row, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(texts(part, "body")):
                ids = encode(text) + tail
                n = len(ids) // 4
                at, p = 0, 0
                while at < n:
                    size = n % capacity or capacity if not at and n > capacity else min(capacity, n - at)
                    row.append(r)
                    piece.append(p)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    at, p = at + size, p + 1
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Ranks within a length are counted per salt (a hash of the whole row) and shifted by the counts of the
    salts before it; equal rows may swap places. An empty table gives an empty result."""
    spark = pieces.sparkSession
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    columns = pieces.columns
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("length").alias("s_length"), F.col("salt").alias("s_salt"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"),
    )
    order = Window.partitionBy("length", "salt").orderBy(*columns)
    ranked = (
        salted.withColumn("rank", F.row_number().over(order))
        .join(shifts, (F.col("length") == F.col("s_length")) & (F.col("salt") == F.col("s_salt")))
        .select(*columns, (F.col("rank") - 1 + F.col("shift")).alias("rank"))
    )
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity).bins)

    def place(batches):
        for b in batches:
            sequence, offset = places(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in columns], pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, files: tuple[str, str], end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every whole text with their places; texts are tokenized once and the pieces stored.

    Null and empty texts are the end id alone; repeated rows are packed one by one; an empty table gives an
    empty result; columns other than ``doc_id`` and ``text`` are ignored."""
    return pack(stored(token_pieces(docs, files, end_id, capacity), "pack-pieces"), capacity)
