"""Spelling variants: words one edit apart, found by dynamic programming over sorted word lists.

**Lists.** One edit leaves one half of a word as it is. Words are therefore dealt to lists by length and first half,
and again, spelled backwards, by length and second half; a list holds the words of a length and of the next one,
and every pair one edit apart meets in a list. A list longer than ``LIST`` words is handed to several tasks, each
of which looks up its own part of the words in the whole list.

**Scan.** A task walks down the sorted list for each of its words. The edit matrix of the word against the list's
word is kept as a band of three diagonals, a row per letter. The next list word keeps the rows of the prefix that it
shares with the one before; where a row has no cell below two, all list words with that prefix are skipped at once.
The words of a chunk walk at the same time, one matrix row a step, in numpy.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored

SHORTEST = 7
FACTOR = 10
#: Words of a list that one task looks up.
LIST = 100_000
#: Letters of the padded words of a chunk that walk at once; a longer list is a chunk of its own.
CELLS = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, run``: every maximal run of letters up to U+00FF of at least so many, A-Z lower-cased."""
    folded = F.translate(F.col(text_col), _UPPER, _LOWER)
    pattern = "[a-zÀ-ÿ]{%d,}" % least
    return docs.select(
        F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(folded, F.lit(pattern), F.lit(0))).alias("run")
    )


def word_counts(words: Column, rows: DataFrame, least: int = SHORTEST, twice: int = 2) -> DataFrame:
    """``word, n`` of the words of at least ``least`` letters that occur at least ``twice`` times."""
    named = rows.select(words.alias("word")).where(F.length("word") >= least)
    return named.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= twice)


def _listed(vocab: DataFrame) -> DataFrame:
    """``base, back, half, word, n, part, own``: the lists of words, by base length, direction and common half."""
    size = F.length("word")

    def entry(base: Column, back: bool) -> Column:
        first = F.floor(base / 2).cast("int")
        word = F.reverse("word") if back else F.col("word")
        shared = base - first if back else first
        return F.struct(
            base.cast("int").alias("base"), F.lit(back).alias("back"), F.substring(word, F.lit(1), shared).alias("half"),
            word.alias("word"),
        )

    entries = F.array(*[entry(size - longer, back) for longer in (0, 1) for back in (False, True)])
    rows = vocab.select(F.explode(entries).alias("e"), "n").select("e.*", "n")
    keys = ["base", "back", "half"]
    long = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > LIST).select(
        *[F.col(k).alias(f"k_{k}") for k in keys], F.ceil(F.col("c") / LIST).cast("int").alias("parts")
    )
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"k_{k}") for k in keys])
    parts = F.coalesce("parts", F.lit(1))
    return rows.join(long, same, "left").select(
        *keys, "word", "n", F.pmod(F.xxhash64("word"), parts).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
    ).select(*keys, "word", "n", "part", (F.col("mine") == F.col("part")).alias("own"))


def walk(letters: np.ndarray, size: np.ndarray, end: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (query, later row of its list) one edit apart.

    ``letters``: the sorted words, padded with 0, a row each; ``end``: end of each row's list."""
    n, width = letters.shape
    at = np.arange(n)
    shared = np.zeros(n + 1, np.int32)
    differ = letters[1:] != letters[:-1]
    shared[1:n] = np.where(differ.any(1), differ.argmax(1), width)
    # leap[d, j]: next row after j that shares at most d letters with the row before it
    leap = np.empty((width + 1, n), np.int32)
    for d in range(width + 1):
        found = np.where(shared[1:] <= d, at + 1, n).astype(np.int32)
        leap[d] = np.minimum.accumulate(found[::-1])[::-1]
    q = query[query + 1 < end[query]]
    j = q + 1
    t = shared[j].astype(np.int64)
    band = np.full((len(q), width + 2, 3), 1, np.uint8)
    band[:, :, 1] = 0
    slot, stop, goal = np.arange(len(q)), end[q], size[q]
    padded = np.zeros((n, width + 3), letters.dtype)
    padded[:, 1 : width + 1] = letters
    left, right = [], []
    while len(q):
        row = band[slot, t]
        w = letters[j, np.minimum(t, width - 1)]
        new = np.empty((len(q), 3), np.uint8)
        for o in range(3):
            # cell: list word up to t + 1, query up to t + o
            cost = row[:, o] + (padded[q, np.minimum(t + o, width + 2)] != w)
            if o < 2:
                cost = np.minimum(cost, row[:, o + 1] + 1)
            if o:
                cost = np.minimum(cost, new[:, o - 1] + 1)
            new[:, o] = np.where(t + o > goal, 2, np.minimum(cost, 2))
        t = t + 1
        band[slot, t] = new
        dead = new.min(1) > 1
        whole = ~dead & (t == size[j])
        if whole.any():
            off = goal - size[j]
            hit = whole & (np.abs(off) <= 1)
            hit[hit] = new[hit, off[hit] + 1] <= 1
            left.append(q[hit])
            right.append(j[hit])
        move = dead | whole
        step = np.where(dead, leap[np.maximum(t - 1, 0), j], j + 1)
        j = np.where(move, step, j)
        t = np.where(move, np.minimum(t, shared[np.minimum(j, n)]), t)
        alive = j < stop
        if not alive.all():
            q, j, t, slot, stop, goal = (x[alive] for x in (q, j, t, slot, stop, goal))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _pairs_of(table: pa.Table) -> pa.RecordBatch:
    """Pairs of one chunk of whole lists, sorted by list and word."""
    words = table.column("word").to_pylist()
    size = np.array([len(w) for w in words], np.int64)
    width = int(size.max())
    letters = np.zeros((len(words), width), np.uint8)
    letters[np.arange(width) < size[:, None]] = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    base = table.column("base").to_numpy()
    back = table.column("back").to_numpy(zero_copy_only=False)
    part, half = table.column("part").to_numpy(), table.column("half").to_numpy(zero_copy_only=False)
    new = np.ones(len(words), bool)
    new[1:] = (base[1:] != base[:-1]) | (back[1:] != back[:-1]) | (part[1:] != part[:-1]) | (half[1:] != half[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(words))[np.cumsum(new) - 1]
    query = np.flatnonzero(table.column("own").to_numpy(zero_copy_only=False))
    x, y = walk(letters, size, end, query)
    ok = np.minimum(size[x], size[y]) == base[x]
    x, y = x[ok], y[ok]
    a, b = [], []
    keep = []
    for i, (u, v) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        one, two = words[u], words[v]
        if back[u]:
            one, two = one[::-1], two[::-1]
            first = int(base[u]) // 2
            if one[:first] == two[:first]:  # met in a list of first halves too
                continue
        keep.append(i)
        a.append(one)
        b.append(two)
    n = table.column("n").to_numpy()
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.string()), pa.array(n[x[keep]]), pa.array(b, pa.string()), pa.array(n[y[keep]])],
        names=["x", "xn", "y", "yn"],
    )


def near_words(vocab: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: both directions of all pairs of words one edit apart."""
    keys = ["base", "back", "half", "part"]
    dealt = _listed(vocab).repartition(*keys).sortWithinPartitions(*keys, "word")

    def run(batches):
        held, cells = [], 0
        for batch in batches:
            held.append(batch)
            cells += batch.num_rows * int(batch.column("base")[batch.num_rows - 1].as_py() + 1) if batch.num_rows else 0
            if cells < CELLS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.slice(table.num_rows - 1)
            mark = [table.column(k).to_numpy(zero_copy_only=False) == last.column(k)[0].as_py() for k in keys]
            cut = int(np.argmax(np.logical_and.reduce(mark)))  # the last list may go on
            if cut:
                yield _pairs_of(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                cells = sum(b.num_rows * int(last.column("base")[0].as_py() + 1) for b in held)
        if held and sum(b.num_rows for b in held):
            yield _pairs_of(pa.Table.from_batches(held).combine_chunks())

    pairs = dealt.mapInArrow(run, "x string, xn bigint, y string, yn bigint")
    both = F.explode(F.array(
        F.struct(F.col("x").alias("word"), F.col("xn").alias("n"), F.col("y").alias("other"), F.col("yn").alias("other_n")),
        F.struct(F.col("y").alias("word"), F.col("yn").alias("n"), F.col("x").alias("other"), F.col("xn").alias("other_n")),
    ))
    return pairs.select(both.alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """``node, root``: the last word that the forms ``word, form`` lead to. A form is more frequent than its word
    by a factor, so chains are short; every round doubles the steps taken."""
    table = stored(forms.select(F.col("word").alias("node"), F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = table.select(F.col("node").alias("from"), F.col("root").alias("to"))
        longer = stored(
            table.join(ahead, F.col("root") == F.col("from"), "left").select(
                "node", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        table = longer.select("node", "root")
        if not longer.where("moved").limit(1).count():
            return table


def variants(vocab: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``.

    A word's form is its near word of largest ``n`` (ties: the first in code-point order) if that is at least
    ``factor`` times its own; the root is the end of the chain of forms. Words must be distinct, made of
    code points up to U+00FF and not null; an empty table gives an empty result. Very long words are compared
    as a whole, in memory that grows with their length."""
    near = near_words(vocab).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    ).select(F.col("word").alias("w"), "n_near", F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    known = stored(
        vocab.join(near, F.col("word") == F.col("w"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(F.col("other_n") >= factor * F.col("n"), F.col("other")).alias("form"), "other_n",
        ),
        "spelling-forms",
    )
    last = roots(known.where("form is not null"))
    return known.join(last, F.col("word") == F.col("node"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.when(F.col("form").isNotNull(), F.col("other_n")).alias("form_n"),
    )
