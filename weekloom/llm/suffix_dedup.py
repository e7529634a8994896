"""Removal of repeated byte strings: every byte covered by a ``LENGTH``-byte string that starts elsewhere too.

Texts are judged as UTF-8 bytes, over the whole table, on the input as it is.

1. *Copies.* Texts are named by their SHA-256; of equal texts one is searched, and all of them are repeats.
2. *Anchors.* The anchor of a window of ``LENGTH`` bytes is the least hash of the ``GRAM``-byte strings in it.
   Equal windows have equal anchors, so windows are sharded by anchor: one narrow row per run of windows with
   one anchor. A run is searched only if its anchor occurs in another place as well.
3. *Shards.* The bytes of such runs go to the shard of their anchor. A shard is worked off in pieces of whole
   anchors, of equal runs one: suffix array by induced sorting, permuted common prefixes, and every window start whose prefix with
   a neighbour reaches ``LENGTH``.
4. *Very common anchors* (``HOT`` runs or more, such as a passage in a third of the texts) are no shard of their
   own: their windows are counted by 64-bit hash, within each task first, and those with two places are
   repeats. That is exact and has no group that grows.
5. Starts become spans per text; the bytes left are hashed.

Defined results: a null text is empty; texts under ``LENGTH`` bytes repeat nothing; rows with equal texts,
repeated rows included, are copies of each other; an empty table gives an empty result; null ids stay; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .arrays import PrefixHash, chunks
from .suffix_array import permuted_lcp, suffix_array

LENGTH, GRAM = 200, 100
HOT = 1000
PIECE_BYTES = 1 << 20
_SPAN = LENGTH - GRAM + 1


def sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """Extreme of every ``width`` neighbours, by block prefixes and suffixes."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, fill, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


def anchor_runs(data: np.ndarray, offsets: np.ndarray):
    """Text number, anchor, first and last window start (within the text) of every run of windows with one
    anchor, and whether the anchor occurs twice within the run."""
    grams = PrefixHash(data).grams(GRAM)
    least = sliding(grams, _SPAN, np.minimum, 2**64 - 1)
    n = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = offsets[text] + start
    anchor = least[place]
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(place)) - 1
    valid = np.zeros(len(least) + 2 * (_SPAN - 1), np.uint64)
    valid[place + _SPAN - 1] = anchor
    chosen = np.flatnonzero(grams == sliding(valid, _SPAN, np.maximum, 0)) if len(head) else head
    # At a distance of _SPAN no window holds both places, but the windows before and after may be one run.
    twin = (grams[chosen[1:]] == grams[chosen[:-1]]) & (np.diff(chosen) <= _SPAN)
    # Windows that hold both places start between these two; all runs there are searched.
    run = np.searchsorted(place[head], np.stack([chosen[1:][twin] - _SPAN + 1, chosen[:-1][twin]]), side="right") - 1
    own = np.zeros(len(head) + 1, np.int64)
    np.add.at(own, np.maximum(run[0], 0), 1)
    np.add.at(own, run[1] + 1, -1)
    own = np.cumsum(own)[:-1] > 0
    return text[head], anchor[head], start[head], start[tail], own


def _spans(starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Ends included in no gap: spans covered by windows at sorted starts."""
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + length


def texts_by_name(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, sha256, name`` per row; ``name`` is 60 bits of the digest."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.sha2(text, 256).alias("sha256"),
    ).withColumn("name", F.conv(F.substring("sha256", 1, 15), 16, 10).cast("bigint"))


def _named_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """``name, n_bytes, body`` of texts of ``LENGTH`` bytes or more."""
    text = F.col(text_col)
    return docs.where(F.octet_length(text) >= LENGTH).select(
        F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint").alias("name"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("body"),
    )


def _first_seen(batches):
    """Batches without the texts that the task has had before."""
    seen = set()
    for b in batches:
        keep = []
        for i, known in enumerate(zip(b.column("name").to_pylist(), b.column("n_bytes").to_pylist(), strict=True)):
            if known not in seen:
                seen.add(known)
                keep.append(i)
        yield b if len(keep) == b.num_rows else b.take(pa.array(keep, pa.int64()))


def anchors(texts: DataFrame) -> DataFrame:
    """``anchor, name, n_bytes, first, last, own`` of every run of windows."""

    def run(batches):
        for part, data, offsets in chunks(_first_seen(batches), "body", PIECE_BYTES // 2):
            text, anchor, first, last, own = anchor_runs(data, offsets)
            row = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), part.column("name").take(row), part.column("n_bytes").take(row),
                 pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(own)],
                names=["anchor", "name", "n_bytes", "first", "last", "own"],
            )

    return texts.mapInArrow(run, "anchor bigint, name bigint, n_bytes bigint, first int, last int, own boolean")


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """Runs whose anchor occurs in two places, with ``hot`` for very common anchors; one row per text with the
    list of its runs (as many as the text has at most)."""
    place = F.xxhash64("name", "n_bytes", "first")
    shared = rows.groupBy("anchor").agg(
        F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("own").alias("twice"),
        (F.count(F.lit(1)) >= HOT).alias("hot"),
    ).where("lo <> hi or twice").select(F.col("anchor").alias("k"), "hot")
    return (
        rows.join(shared, F.col("anchor") == F.col("k"))
        .groupBy("name", "n_bytes")
        .agg(F.collect_set(F.struct("first", "last", "anchor", "hot")).alias("runs"))
    )


def _runs_of(part: pa.RecordBatch, hot: bool):
    """Text number and run of the runs of one kind."""
    for i, runs in enumerate(part.column("runs").to_pylist()):
        for r in runs:
            if r["hot"] == hot:
                yield i, r


def segments(texts: DataFrame) -> DataFrame:
    """``anchor, name, n_bytes, first, last, bytes``: bytes of the runs that are searched in shards."""

    def run(batches):
        seen = set()
        for part, data, offsets in chunks(batches, "body"):
            names, sizes = part.column("name").to_pylist(), part.column("n_bytes").to_pylist()
            out = []
            for i, r in _runs_of(part, False):
                known = (names[i], sizes[i], r["first"])
                if known not in seen:
                    seen.add(known)
                    at = offsets[i] + r["first"]
                    out.append((r["anchor"], *known, r["last"],
                                data[at : at + r["last"] - r["first"] + LENGTH].tobytes()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["anchor", "name", "n_bytes", "first", "last", "bytes"],
                )

    return texts.mapInArrow(
        run, "anchor bigint, name bigint, n_bytes bigint, first int, last int, bytes binary"
    )


def repeated_starts(parts: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """For each segment the starts, below its count, of windows that occur at another place of the segments."""
    joined = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    begin = np.cumsum([0] + [len(p) + 1 for p in parts])
    sa = suffix_array(joined.astype(np.int64) + 1)
    lcp, phi = permuted_lcp(joined, sa)
    hit = lcp >= LENGTH
    flag = hit.copy()
    flag[phi[hit]] = True
    return [np.flatnonzero(flag[a : a + n]) for a, n in zip(begin, counts, strict=False)]


def _span_rows(found) -> pa.RecordBatch:
    """One row per text and span, from (name, n_bytes, starts)."""
    name, size, lo, hi = [], [], [], []
    for n, s, starts in found:
        if len(starts):
            a, b = _spans(starts)
            name += [n] * len(a)
            size += [s] * len(a)
            lo.append(a)
            hi.append(b)
    join = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(name, pa.int64()), pa.array(size, pa.int64()), join(lo), join(hi)],
        names=["name", "n_bytes", "lo", "hi"],
    )


SPANS = "name bigint, n_bytes bigint, lo bigint, hi bigint"


def _search(rows: list[tuple]) -> list[np.ndarray]:
    """Starts of repeated windows in each segment of a piece. Segments are grouped by anchor; of equal ones, all of
    whose windows are repeats of each other, one is searched, and only next to different ones."""
    groups: dict[int, dict[bytes, list[int]]] = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[0], {}).setdefault(r[5], []).append(i)
    starts = [np.zeros(0, np.int64)] * len(rows)
    open_rows: list[int] = []
    for contents in groups.values():
        for same in contents.values():
            if len(same) > 1:
                for i in same:
                    starts[i] = np.arange(rows[i][4] - rows[i][3] + 1)
            if len(contents) > 1 or len(same) == 1:
                open_rows.append(same[0])
    if open_rows:
        found = repeated_starts([rows[i][5] for i in open_rows], [rows[i][4] - rows[i][3] + 1 for i in open_rows])
        for i, s in zip(open_rows, found, strict=True):
            if not len(starts[i]):
                starts[i] = s
    return starts


def search_shards(parts: DataFrame) -> DataFrame:
    """Spans of repeated windows within segments, shard by shard."""

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            distinct = {(r[1], r[2], r[3]): r for r in held}
            rows = list(distinct.values())
            return _span_rows((r[1], r[2], s + r[3]) for r, s in zip(rows, _search(rows), strict=True))

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size >= PIECE_BYTES and r[0] != held[-1][0]:
                    yield flush()
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
        if held:
            yield flush()

    return parts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, SPANS)


def search_windows(texts: DataFrame) -> DataFrame:
    """Spans of repeated windows in the runs of very common anchors: windows whose hash has two places.

    The count per hash is a partial aggregate, so a window that is in every text costs one row per task."""
    columns = "h bigint, name bigint, n_bytes bigint, start int"

    def run(batches):
        for part, data, offsets in chunks(batches, "body"):
            picked = list(_runs_of(part, True))
            if not picked:
                continue
            hashes = PrefixHash(data)
            text = np.concatenate([np.full(r["last"] - r["first"] + 1, i) for i, r in picked])
            start = np.concatenate([np.arange(r["first"], r["last"] + 1) for i, r in picked])
            at = offsets[text] + start
            h = hashes.of(at, at + LENGTH)
            row = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), part.column("name").take(row), part.column("n_bytes").take(row),
                 pa.array(start.astype(np.int32))],
                names=["h", "name", "n_bytes", "start"],
            )

    windows = stored(texts.mapInArrow(run, columns), "suffix-windows")
    place = F.xxhash64("name", "n_bytes", "start")
    repeated = windows.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi")
    found = windows.join(repeated.select(F.col("h").alias("k")), F.col("h") == F.col("k"), "left_semi")
    listed = found.groupBy("name", "n_bytes").agg(F.sort_array(F.collect_set("start")).alias("starts"))

    def spans(batches):
        for b in batches:
            yield _span_rows(
                (n, s, np.array(x)) for n, s, x in zip(*(c.to_pylist() for c in b.columns), strict=True)
            )

    return listed.mapInArrow(spans, SPANS)


def _removal(texts: DataFrame) -> DataFrame:
    """``name, n_bytes, n_removed, n_spans, kept_sha256, spans`` of texts with lists of spans."""

    def run(batches):
        for part, data, offsets in chunks(batches, "body"):
            out = []
            for i, found in enumerate(part.column("found").to_pylist()):
                edges = np.array(sorted((x["lo"], x["hi"]) for x in found))
                reach = np.maximum.accumulate(edges[:, 1])
                new = np.concatenate([[True], edges[1:, 0] > reach[:-1]])
                lo = edges[new, 0]
                hi = reach[np.append(np.flatnonzero(new)[1:], len(edges)) - 1]
                own = data[offsets[i] : offsets[i + 1]]
                keep = np.ones(len(own) + 1, np.int64)
                change = np.zeros(len(own) + 1, np.int64)
                change[lo] += 1
                change[hi] -= 1
                keep = np.cumsum(change)[:-1] == 0
                out.append((int((hi - lo).sum()), len(lo), hashlib.sha256(own[keep].tobytes()).hexdigest(),
                            [{"lo": int(a), "hi": int(b)} for a, b in zip(lo, hi, strict=True)]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
            cells = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("name"), part.column("n_bytes"), *cells],
                names=["name", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return texts.mapInArrow(
        run, "name bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<lo:bigint,hi:bigint>>"
    )


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (byte offsets, end exclusive) per row."""
    named = stored(texts_by_name(docs, id_col, text_col), "suffix-names")
    texts = _named_texts(docs, text_col)
    marks = repeated_anchors(stored(anchors(texts), "suffix-anchors"))
    on = ["name", "n_bytes"]
    marked = stored(
        texts.mapInArrow(_first_seen, "name bigint, n_bytes bigint, body string").join(marks.select(F.col("name").alias("m"), F.col("n_bytes").alias("mb"), "runs"),
                   (F.col("name") == F.col("m")) & (F.col("n_bytes") == F.col("mb"))).select(*on, "body", "runs"),
        "suffix-texts",
    )
    spans = search_shards(segments(marked)).union(search_windows(marked))
    found = spans.groupBy(*on).agg(F.collect_set(F.struct("lo", "hi")).alias("found")).select(
        F.col("name").alias("m"), F.col("n_bytes").alias("mb"), "found"
    )
    removed = _removal(
        marked.select(*on, "body")
        .join(found, (F.col("name") == F.col("m")) & (F.col("n_bytes") == F.col("mb"))).select(*on, "body", "found")
    ).select(*[F.col(c).alias(f"r_{c}") for c in on], "n_removed", "n_spans", "kept_sha256", "spans").dropDuplicates(
        ["r_name", "r_n_bytes"]
    )
    copies = named.where(F.col("n_bytes") >= LENGTH).groupBy(*on).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(
        F.col("name").alias("c_name"), F.col("n_bytes").alias("c_bytes")
    )
    facts = removed.join(copies, (F.col("r_name") == F.col("c_name")) & (F.col("r_n_bytes") == F.col("c_bytes")), "full").select(
        F.coalesce("r_name", "c_name").alias("f_name"), F.coalesce("r_n_bytes", "c_bytes").alias("f_bytes"),
        "n_removed", "n_spans", "kept_sha256", "spans", F.col("c_name").isNotNull().alias("copied"),
    )
    joined = named.join(facts, (F.col("name") == F.col("f_name")) & (F.col("n_bytes") == F.col("f_bytes")), "left")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("lo"), F.col("n_bytes").alias("hi")))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    return joined.select(
        "doc_id", "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
        F.when(F.col("copied"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(F.col("copied"), whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
