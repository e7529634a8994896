"""Phrases of two to four words that stand together more often than their parts, by top-order marginalisation.

Texts (null: empty; A-Z lower-cased) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``; everything is counted per language (null: ``und``).

**Windows.** Every word leads one window: itself and the next three words of its piece, padded at the end. Only
these windows are counted. An occurrence of a phrase is the beginning of exactly one window, so a Spark ROLLUP
over the four window columns sums the counts of all shorter phrases; no other n-grams are made.

**Narrow windows.** A window is two integers of two word numbers each. The numbers of the most frequent words
(``TOP`` at most, one fixed size whatever the corpus) are handed to the tasks; words below ``LEAST`` occurrences
end a window like a piece does, because no phrase that holds them counts. If more words reach ``LEAST`` than
``TOP``, windows are cut before the others and phrases that hold one are counted as strings beside.

**Pruning.** Windows are dealt by their first two words, so sums of shorter prefixes are known in place and
prefixes below ``LEAST`` are cut off before the ROLLUP. Where both first words are hot (over one in ``HOT`` of all
words, so at most ``HOT`` words), the third joins the key, then the fourth; no key holds more than one in ``HOT``
of the windows, apart from equal windows, which the tasks have added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .arrays import FOLDED_VALUES, PrefixHash, chunks, mix, owners, utf8, words

LONGEST = 4
LEAST = 30
TOP = 1 << 20
HOT = 500
PER_LANG = 2000
#: Bytes of text a task works on at once.
CHUNK = 1 << 19
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN = _BREAKS.copy()
_BETWEEN[[0x20, 0x09]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class _Tokens:
    """Words of the texts of a chunk: places, pieces, and hashes of language and word."""

    def __init__(self, langs: pa.Array, data: np.ndarray, offsets: np.ndarray):
        self.data = _FOLD[data]
        self.starts, self.ends, at = words(data, offsets, _BETWEEN)
        self.text = owners(at)
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_BREAKS[data], out=breaks[1:])
        self.piece = breaks[self.starts]
        named, edges = utf8(langs)
        lang = PrefixHash(named).of(edges[:-1], edges[1:])
        word = PrefixHash(data, FOLDED_VALUES).of(self.starts, self.ends)
        self.key = mix(word + lang[self.text] * np.uint64(0x9E3779B97F4A7C15))

    def spelled(self, at: np.ndarray) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]

    def same_piece(self, step: int) -> np.ndarray:
        """True where the word so many places on is in the same piece."""
        same = np.zeros(len(self.key), bool)
        if step < len(self.key):
            same[:-step] = (self.piece[step:] == self.piece[:-step]) & (self.text[step:] == self.text[:-step])
        return same


def _narrow(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("body"))


def vocabulary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, word, key, n``: occurrences of every word of every language."""

    def run(batches):
        for part, data, offsets in chunks(batches, "body", CHUNK):
            t = _Tokens(part.column("lang"), data, offsets)
            key, first, n = np.unique(t.key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(pa.array(t.text[first])), pa.array(t.spelled(first), pa.string()),
                 pa.array(key.view(np.int64)), pa.array(n)], names=["lang", "word", "key", "n"],
            )

    rows = _narrow(docs, lang_col, text_col).mapInArrow(run, "lang string, word string, key bigint, n bigint")
    return rows.groupBy("lang", "word").agg(F.min("key").alias("key"), F.sum("n").alias("n"))


class Numbers:
    """Numbers, from 1 by falling frequency, of the words that reach ``least``, ``top`` at most.

    ``hot``: the words up to this number are more than one in ``HOT`` of all. ``complete``: no word that reaches
    ``least`` was left out."""

    def __init__(self, vocab: DataFrame, least: int, top: int):
        level = F.floor(F.log2("n") * 8).cast("int")
        often = vocab.where(F.col("n") >= least)
        tally = dict(often.groupBy(level.alias("v")).count().collect())  # at most 512 rows
        total, chosen, lowest = 0, 0, 1 << 30
        for v in sorted(tally, reverse=True):
            if chosen + tally[v] > top:
                break
            chosen, lowest = chosen + tally[v], v
        self.complete = chosen == sum(tally.values())
        found = often.where(level >= lowest).select("key", "n").toArrow()
        key, n = (found.column(c).to_numpy() for c in ("key", "n"))
        order = np.lexsort((key, -n))
        total = vocab.agg(F.sum("n")).first()[0] or 0
        self.hot = int((n * HOT > total).sum())
        by_key = np.argsort(key.view(np.uint64)[order])
        self.keys, self.number = key.view(np.uint64)[order][by_key], (by_key + 1).astype(np.int32)

    def of(self, key: np.ndarray) -> np.ndarray:
        """Number of each word, 0 if it has none."""
        if not len(self.keys):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.number[at], 0).astype(np.int64)


def windows(docs: DataFrame, numbers: Numbers, lang_col: str, text_col: str) -> DataFrame:
    """``k1, k2, n``: longest windows as two pairs of numbers, added up per chunk of texts."""

    def run(batches):
        for part, data, offsets in chunks(batches, "body", CHUNK):
            t = _Tokens(part.column("lang"), data, offsets)
            number = numbers.of(t.key)
            lead = [number]
            inside = np.ones(len(number), bool)
            for step in range(1, LONGEST):
                inside &= (lead[-1] > 0) & t.same_piece(step)
                lead.append(np.where(inside, np.roll(number, -step), 0))
            a, b, c, d = (x[number > 0] for x in lead)
            k1, k2 = (a << 32) | b, (c << 32) | d
            order = np.lexsort((k2, k1))
            k1, k2 = k1[order], k2[order]
            new = np.ones(len(k1), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(k1)))
            yield pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array(n)], names=["k1", "k2", "n"])

    return _narrow(docs, lang_col, text_col).mapInArrow(run, "k1 bigint, k2 bigint, n bigint")


def _word(i: int) -> Column:
    key = F.col("k1" if i < 2 else "k2")
    return key.bitwiseAND(F.lit((1 << 32) - 1)) if i % 2 else F.shiftright(key, 32)


def pruned(rows: DataFrame, hot: int, least: int) -> DataFrame:
    """``a, b, c, d, n``: windows without the words past a prefix that cannot reach ``least``; 0 is no word."""
    a, b, c, d = map(_word, range(LONGEST))
    two = (a <= hot) & (b <= hot) & (b > 0)
    three = two & (c <= hot) & (c > 0)
    deal = F.when(three, F.xxhash64("k1", "k2")).when(two, F.xxhash64("k1", c)).otherwise(F.xxhash64("k1"))
    dealt = rows.repartition(deal)

    def total(*keys):
        return F.sum("n").over(Window.partitionBy(deal, *keys))

    known = dealt.select("k1", "k2", "n", total("k1", c, "k2").alias("n4"), total("k1", c).alias("n3"),
                         total("k1").alias("n2"))
    keep2 = two | (F.col("n2") >= least)
    keep3 = keep2 & (three | (F.col("n3") >= least))
    keep4 = keep3 & (F.col("n4") >= least)
    cut = known.select(
        a.alias("a"), F.when(keep2, b).otherwise(0).alias("b"), F.when(keep3, c).otherwise(0).alias("c"),
        F.when(keep4, d).otherwise(0).alias("d"), "n",
    )
    return cut.groupBy("a", "b", "c", "d").agg(F.sum("n").alias("n"))


def _rolled(rows: DataFrame, columns: list[str], least: int) -> DataFrame:
    """ROLLUP sums with ``size``, the number of leading columns kept; other columns are null."""
    kept = F.lit(LONGEST) - F.bit_count(F.grouping_id()).cast("int")
    return rows.rollup(*columns).agg(F.sum("n").alias("f"), kept.alias("size")).where((F.col("f") >= least) & (F.col("size") > 0))


def numbered_phrases(docs: DataFrame, numbers: Numbers, vocab: DataFrame, least: int, lang_col: str, text_col: str) -> DataFrame:
    """``lang, phrase, size, f`` of phrases whose words all have numbers."""
    names = list("abcd")
    counted = stored(pruned(windows(docs, numbers, lang_col, text_col), numbers.hot, least), "phrase-windows")
    rolled = _rolled(counted, names, least)
    last = F.coalesce(*[F.col(c) for c in reversed(names)])
    found = stored(rolled.where(last > 0), "phrase-sums")

    def run(batches):
        for batch in batches:
            number = numbers.of(batch.column("key").to_numpy().view(np.uint64))
            named = pa.RecordBatch.from_arrays(
                [pa.array(number), batch.column("lang"), batch.column("word")], names=["number", "l", "w"]
            )
            yield named.filter(pa.array(number > 0))

    spelled = stored(
        vocab.where(F.col("n") >= least).select("key", "lang", "word").mapInArrow(run, "number bigint, l string, w string"),
        "phrase-words",
    )
    for i, c in enumerate(names):
        word = spelled.select(F.col("number").alias(f"n{i}"), F.col("w").alias(f"w{i}"), F.col("l").alias(f"l{i}"))
        found = found.join(word, F.col(c) == F.col(f"n{i}"), "inner" if not i else "left")
    return found.select(
        F.col("l0").alias("lang"), F.concat_ws(" ", *[f"w{i}" for i in range(LONGEST)]).alias("phrase"), "size", "f"
    )


def spelled_phrases(docs: DataFrame, numbers: Numbers, least: int, lang_col: str, text_col: str) -> DataFrame:
    """``lang, phrase, size, f`` of phrases with a word that has no number, counted as strings.

    ``since`` is the place of the first such word; shorter prefixes have been counted by number."""
    names = [f"w{i}" for i in range(LONGEST)]

    def run(batches):
        for part, data, offsets in chunks(batches, "body", CHUNK):
            t = _Tokens(part.column("lang"), data, offsets)
            bare = numbers.of(t.key) == 0
            reach, since = np.ones(len(bare), np.int64), np.where(bare, 0, LONGEST)
            for step in range(1, LONGEST):
                same = t.same_piece(step)
                reach += same
                since = np.where(same & np.roll(bare, -step) & (since == LONGEST), step, since)
            at = np.flatnonzero(since < LONGEST)
            columns = []
            for step in range(LONGEST):
                there = reach[at] > step
                text = np.full(len(at), None, object)
                text[there] = t.spelled(at[there] + step)
                columns.append(pa.array(text, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(pa.array(t.text[at])), pa.array(since[at].astype(np.int32)), *columns],
                names=["lang", "since", *names],
            )

    rows = _narrow(docs, lang_col, text_col).mapInArrow(
        run, "lang string, since int, " + ", ".join(f"{c} string" for c in names)
    )
    counted = rows.groupBy("lang", "since", *names).agg(F.count(F.lit(1)).alias("n"))
    keys = ["lang", "since"]
    kept = F.lit(LONGEST) - F.bit_count(F.grouping_id()).cast("int")
    rolled = counted.rollup(*keys, *names).agg(F.sum("n").alias("f"), kept.alias("size"))
    last = F.get(F.array(*names), F.col("size") - 1)
    return (
        rolled.where((F.col("size") > F.col("since")) & (F.col("size") > 0)).where(last.isNotNull())
        .groupBy("lang", F.concat_ws(" ", *names).alias("phrase"), "size").agg(F.sum("f").alias("f"))
        .where(F.col("f") >= least)
    )


def phrase_counts(
    docs: DataFrame, vocab: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``lang, phrase, size, f`` of all phrases of one to four words with at least ``least`` occurrences."""
    numbers = Numbers(vocab, least, top)
    found = numbered_phrases(docs, numbers, vocab, least, lang_col, text_col)
    if not numbers.complete:
        found = found.unionByName(spelled_phrases(docs, numbers, least, lang_col, text_col))
    return stored(found, "phrase-counts")


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang, phrase, size, a, l, r, score``."""
    cand = counts.where("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = cand.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "size", F.col("f").alias("a"), "k",
        _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    one = counts.select(F.col("lang").alias("l1"), F.col("phrase").alias("p1"), F.col("f").alias("l"))
    two = counts.select(F.col("lang").alias("l2"), F.col("phrase").alias("p2"), F.col("f").alias("r"))
    both = cuts.join(one, (F.col("lang") == F.col("l1")) & (F.col("head") == F.col("p1"))).join(
        two, (F.col("lang") == F.col("l2")) & (F.col("tail") == F.col("p2"))
    )
    score = F.expr("(cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0))) div (cast(l as decimal(20,0)) + r)")
    return both.groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    ).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame) -> DataFrame:
    """``lang, phrase, most``: phrases inside longer candidates, with the largest count of such a candidate."""
    cand = counts.where("size > 2").withColumn("w", F.split("phrase", " "))
    spans = [(i, k) for k in range(2, LONGEST) for i in range(LONGEST - k + 1)]
    parts = F.array(*[
        F.when((F.lit(i + k) <= F.col("size")) & (F.lit(k) < F.col("size")), _part(F.lit(i + 1), F.lit(k)))
        for i, k in spans
    ])
    rows = cand.select(F.col("lang").alias("in_lang"), F.explode(F.array_compact(parts)).alias("inner"), "f")
    return rows.groupBy("in_lang", "inner").agg(F.max("f").alias("most"))


def collocations(
    docs: DataFrame, per_lang: int = PER_LANG, least: int = LEAST, top: int = TOP,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language.

    Null and empty texts have no words, null languages count as ``und``, repeated rows count again, ties go to
    the larger count and then to the phrase in byte order; an empty table gives an empty result and other columns
    are ignored. A very long text is worked on as a whole, in some hundred bytes of memory a byte."""
    vocab = stored(vocabulary(docs, lang_col, text_col), "phrase-vocabulary")
    counts = phrase_counts(docs, vocab, least, top, lang_col, text_col)
    inside = covered(counts)
    kept = scored(counts).join(
        inside, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left"
    ).where("most is null or cast(most as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * 80")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.select("lang", "phrase", "a", "l", "r", "score", F.row_number().over(order).alias("rank")).where(
        F.col("rank") <= per_lang
    )
    totals = vocab.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"))
    return ranked.join(totals, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
