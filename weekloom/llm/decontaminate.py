"""Benchmark decontamination: BM25 over an inverted index of the test items, searched block by block.

The index holds the items, a few thousand per shard; training texts are the queries. A text is cut into
overlapping passages of twice the longest item, so that every occurrence of an item lies within one. A
score is the BM25 score of the item for the passage, divided by the item's score for itself (0 to 1);
every (passage, item) with a score of ``least`` or more is retrieved, by block-max WAND:

* Postings are grouped into blocks of items; a term keeps its largest impact in each block.
* Within a block, the commonest terms whose impacts together stay below half of ``least`` for each of its
  items are not essential: a passage without an essential term of a block cannot reach the threshold there.
* Impact maxima of the essential terms in a passage, plus the most the other terms could add, bound the
  scores of a block; only blocks whose bound reaches ``least`` are scored, and then exactly.

A retrieved pair is verified in its passage. Without an answer, a share of the item's words must lie in 2-word
sequences that the passage has too, wherever in the item they are. With an answer (from a column), a share of
the 3-word sequences of the question, and of those of the answer, must be in the passage.

More items mean more shards, each a bounded index shipped to the workers; one pass searches ``PASS_SHARDS`` of them.
Item count, document frequencies, mean and largest length are those of all items, whatever the number of shards.
Defined results: null or empty texts and items match nothing; repeated rows are searched one by one; without
texts or items the result is empty; columns other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.scratch import stored
from .arrays import PUNCTUATION, PrefixHash, chunks, mix, owners, utf8, words

LEAST = 0.6
OVERLAP = 0.6
BLOCK = 4
#: The terms of a block that may go unread can add at most this share of the threshold to a score.
FREE = 0.5
K1, B = 1.2, 0.75
#: Bounds of one index shard, and shards that one pass over the texts searches.
SHARD_ITEMS, SHARD_BYTES = 4000, 4 << 20
PASS_SHARDS = 8
#: Bytes of text a task works on at once.
CHUNK = 1 << 19


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of texts, and their offsets."""
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, at = words(data, offsets, PUNCTUATION)
    return PrefixHash(data).of(starts, ends), at


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` words in a row, in order."""
    if not width or len(h) < width:
        return h[:0]
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total = mix(total + h[k : len(h) - width + 1 + k])
    return total


class Passage:
    """Words of a passage, and their distinct sequences by width."""

    def __init__(self, h: np.ndarray):
        self.h = h
        self.known: dict[int, np.ndarray] = {}

    def sequences(self, width: int) -> np.ndarray:
        if width not in self.known:
            self.known[width] = np.unique(rolled(self.h, width))
        return self.known[width]


@dataclass(frozen=True)
class Part:
    """Sequences of an item, in order; an item shorter than ``width`` is one sequence."""

    h: np.ndarray
    width: int

    @classmethod
    def of(cls, h: np.ndarray, width: int) -> Part:
        width = min(width, len(h))
        return cls(rolled(h, width), width)

    def hits(self, passage: Passage) -> np.ndarray:
        return np.isin(self.h, passage.sequences(self.width))

    def sequence_share(self, passage: Passage) -> float:
        """Share of the distinct sequences that the passage has; 1 if there are none."""
        return float(self.hits(passage)[np.unique(self.h, return_index=True)[1]].mean()) if len(self.h) else 1.0

    def word_share(self, passage: Passage) -> float:
        """Share of the words that lie in a sequence of the passage; 1 if there are none."""
        hits = self.hits(passage)
        covered = np.zeros(len(hits) + max(0, self.width - 1), bool)
        for k in range(self.width):
            covered[k : k + len(hits)] |= hits
        return float(covered.mean()) if len(covered) else 1.0


@dataclass(frozen=True)
class Block:
    items: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray


@dataclass(frozen=True)
class Collection:
    """What scores need to know of all items: their number, mean and largest length, and the document frequency of terms
    (sorted by hash)."""

    n: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


class ItemIndex:
    """Inverted index of one shard of items. ``about`` describes all items; without it the shard is all there are.

    An item without an answer is verified as a whole if ``whole`` is set, as the operators do. Else its last third
    takes the place of an answer, and a part under three words is in no passage."""

    def __init__(self, items: list[tuple[object, str, str | None]], least: float = LEAST, whole: bool = False,
                 about: Collection | None = None):
        self.ids = [i for i, _, _ in items]
        self.least = least
        h, at = term_hashes(pa.array([f"{q} {a}" if a else q for _, q, a in items], pa.string()))
        answers, answer_at = term_hashes(pa.array([a for _, _, a in items], pa.string()))
        lengths = np.diff(at)
        self.parts = []
        for k, (_, _, a) in enumerate(items):
            own = h[at[k] : at[k + 1]]
            cut = len(own) - (answer_at[k + 1] - answer_at[k] if a else -(-len(own) // 3))
            if a:
                self.parts.append((Part.of(own[:cut], 3), Part.of(own[cut:], 3)))
            elif whole:
                self.parts.append((Part.of(own, 2), None))
            else:
                self.parts.append(tuple(Part(Part.of(x, 3).h, 3) for x in (own[:cut], own[cut:])))
        self.stride = int(max(16, lengths.max(initial=0) if about is None else about.longest))
        self.vocabulary, term = np.unique(h, return_inverse=True)
        pairs, tf = np.unique(owners(at) * max(1, len(self.vocabulary)) + term, return_counts=True)
        item, term = np.divmod(pairs, max(1, len(self.vocabulary)))
        df = np.bincount(term, minlength=len(self.vocabulary))
        n, mean = len(items), lengths.mean() if len(lengths) else 1
        if about is not None:
            n, mean, df = about.n, about.mean, about.df[np.searchsorted(about.terms, self.vocabulary)]
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1e-9, mean))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[item])
        self_score = np.bincount(item, impact, len(items))
        impact = impact / self_score[item]
        self.blocks, post_term, post_block, post_max, rest = [], [], [], [], []
        for first in range(0, len(items), BLOCK):
            own = np.flatnonzero((item >= first) & (item < first + BLOCK))
            terms, row = np.unique(term[own], return_inverse=True)
            impacts = np.zeros((len(terms), min(BLOCK, len(items) - first)))
            impacts[row, item[own] - first] = impact[own]
            common = np.argsort(-df[terms], kind="stable")
            upto = np.cumsum(impacts[common], axis=0).max(axis=1) if len(terms) else np.zeros(0)
            free = int(np.searchsorted(upto, FREE * least))
            rest.append(upto[free - 1] if free else 0.0)
            essential = common[free:]
            post_term.append(terms[essential])
            post_block.append(np.full(len(essential), len(self.blocks)))
            post_max.append(impacts[essential].max(axis=1, initial=0.0))
            self.blocks.append(Block(np.arange(first, first + impacts.shape[1]), terms, impacts))
        self.rest = np.array(rest)
        order = np.argsort(np.concatenate(post_term), kind="stable") if items else np.zeros(0, np.int64)
        self.posting_block = np.concatenate(post_block)[order] if items else order
        self.posting_max = np.concatenate(post_max)[order] if items else np.zeros(0)
        n_post = np.bincount(
            np.concatenate(post_term) if items else order, minlength=len(self.vocabulary)
        )
        self.posting_at = np.concatenate([[0], np.cumsum(n_post)])

    def search(self, column: pa.Array) -> list[tuple[int, int, float, float, float | None]]:
        """(text, item, score, question share, answer share) of the verified pairs of a few texts; without an
        answer, the share of the whole item and null."""
        if not len(self.vocabulary):
            return []
        h, at = term_hashes(column)
        owner = owners(at)
        term = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[term] == h)
        n_post = np.diff(self.posting_at)
        use = known[n_post[term[known]] > 0]
        steps = -(-np.diff(at) // self.stride)
        first_window = np.concatenate([[0], np.cumsum(steps)])
        window = first_window[owner[use]] + (use - at[owner[use]]) // self.stride
        many = n_post[term[use]]
        posting = np.repeat(self.posting_at[term[use]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        cell = np.repeat(window, many) * len(self.blocks) + self.posting_block[posting]
        size = first_window[-1] * len(self.blocks)
        bound = np.bincount(cell, self.posting_max[posting], size).astype(float).reshape(first_window[-1], len(self.blocks))
        final = np.zeros(first_window[-1], bool)
        final[first_window[1:][steps > 0] - 1] = True
        both = bound.copy()
        both[:-1] += np.where(final[:-1, None], 0.0, bound[1:])
        found: dict[tuple[int, int], tuple[float, float, float | None]] = {}
        places = np.argwhere((both > 0) & (both + self.rest >= self.least - 1e-9))
        last, present = -1, None
        for w, b in places.tolist():
            if w != last:
                text = int(np.searchsorted(first_window, w, side="right")) - 1
                start = at[text] + (w - first_window[text]) * self.stride
                own = h[start : min(at[text + 1], start + 2 * self.stride)]
                near = term[start : start + len(own)]
                present, passage, last = np.unique(near[self.vocabulary[near] == own]), Passage(own), w
            block = self.blocks[b]
            scores = block.impacts[np.isin(block.terms, present, assume_unique=True)].sum(axis=0)
            for k in np.flatnonzero(scores >= self.least - 1e-9):
                item = int(block.items[k])
                q, a = self.parts[item]
                shares = (q.word_share(passage),) if a is None else (q.sequence_share(passage), a.sequence_share(passage))
                if min(shares) >= OVERLAP:
                    key = (text, item)
                    hit = (float(scores[k]), *shares) if a else (float(scores[k]), *shares, None)
                    if key not in found or hit[: 1 + len(shares)] > found[key][: 1 + len(shares)]:
                        found[key] = hit
        return [(*k, *v) for k, v in sorted(found.items())]


def _item_terms(rows: DataFrame) -> DataFrame:
    """``shard, size, terms`` of items ``shard, q, a``: number of words and distinct terms."""

    def run(batches):
        for batch in batches:
            texts = [f"{q} {a}" if a else q for q, a in zip(batch.column("q").to_pylist(), batch.column("a").to_pylist(), strict=True)]
            h, at = term_hashes(pa.array(texts, pa.string()))
            terms = [np.unique(h[x:y]).view(np.int64) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), pa.array(np.diff(at)), pa.array(terms, pa.list_(pa.int64()))],
                names=["shard", "size", "terms"],
            )

    return rows.select("shard", "q", "a").mapInArrow(run, "shard int, size bigint, terms array<bigint>")


def item_shards(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                answer_col: str | None = None) -> list[ItemIndex]:
    """Indexes of bounded size over all items, ordered by id within a shard. Scores follow all items, counted by Spark,
    so they do not depend on the number of shards."""
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = items.select(
        F.col(id_col).alias("i"), F.col(text_col).alias("q"), answer.alias("a")
    ).where("q is not null and q <> ''")
    size = rows.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("q")), F.lit(0)).alias("b")
    ).first()
    shards = max(-(-size["n"] // SHARD_ITEMS), -(-size["b"] // SHARD_BYTES))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("i", "q"), F.lit(max(1, shards))).cast("int"))
    if shards > 1:
        per = stored(_item_terms(rows), "item-terms")
        whole = per.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.max("size").alias("longest")).first()
        counts = stored(per.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")), "item-df")
    out = []
    for k in range(shards):
        part = rows.where(F.col("shard") == k).collect()
        if not part:
            continue
        about = None
        if shards > 1:
            own = per.where(F.col("shard") == k).select(F.explode("terms").alias("own")).distinct()
            known = counts.join(own, F.col("t") == F.col("own"), "left_semi").toArrow()
            terms = known.column("t").to_numpy().view(np.uint64)
            order = np.argsort(terms)
            about = Collection(whole["n"], whole["words"] / whole["n"], whole["longest"], terms[order],
                               known.column("df").to_numpy()[order])
        rank = lambda x: (x[0] is None, x[0] or 0 if not isinstance(x[0], str) else x[0], x[1])
        out.append(ItemIndex(sorted(((r["i"], r["q"], r["a"]) for r in part), key=rank), whole=True, about=about))
    return out


def _passes(indexes: list[ItemIndex]) -> list[list[ItemIndex]]:
    return [indexes[k : k + PASS_SHARDS] for k in range(0, len(indexes), PASS_SHARDS)]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every verified pair. For an item without an
    answer, ``question_overlap`` is the share of the whole item and ``answer_overlap`` is null."""
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    item_type = to_arrow_type(items.schema[item_col].dataType)
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double"
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    found = docs.sparkSession.createDataFrame([], schema)
    for indexes in _passes(item_shards(items, item_col, item_text_col, answer_col)):

        def run(batches, indexes=indexes):
            for part, _, _ in chunks(batches, "body", CHUNK):
                for index in indexes:
                    hits = index.search(part.column("body"))
                    if hits:
                        doc = part.column("doc_id").take(pa.array([x[0] for x in hits], pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [doc, pa.array([index.ids[x[1]] for x in hits], item_type),
                             *[pa.array([x[k] for x in hits], pa.float64()) for k in (2, 3, 4)]],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

        found = found.unionByName(narrow.mapInArrow(run, schema))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` that hold no test item, unchanged; rows are filtered where they are read."""
    for indexes in _passes(item_shards(items, item_col, item_text_col, answer_col)):

        def run(batches, indexes=indexes):
            for part, _, _ in chunks(batches, text_col, CHUNK):
                bad = {x[0] for index in indexes for x in index.search(part.column(text_col))}
                yield part.take(pa.array([i for i in range(part.num_rows) if i not in bad], pa.int64()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
