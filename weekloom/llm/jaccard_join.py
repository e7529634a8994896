"""Similarity join on 3-word shingles at 90 % Jaccard, by size-banded tiles with bitmap signatures.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text's set is its distinct 3-word shingles (all its
words if there are fewer), as 64-bit hashes. Texts with equal sets form a class; only its least id goes on.

**Tiles.** Two sets this similar have sizes in the ratio 9 to 10, so sizes are cut into bands in which a partner
is in the same or the next band. They also share a shingle among the first ``n - ceil(0.9 n) + 1`` of each set in
any fixed order. Shingles are ordered by the occurrences of their rarest word (a table of ``SLOTS`` hashed words,
of one size whatever the corpus), so frequent phrases and passages come last and are seldom keys. A tile is
one shingle with two neighbouring bands.

**Bounds.** Each set has a bitmap of at least half as many bits as shingles, in which every shingle flips one bit.
The bits in which two bitmaps differ cannot outnumber the shingles in which the sets differ, so the bit count
bounds the overlap from above. Only pairs that pass go to the exact intersection of the sorted sets.

**Links.** In each tile every set is first checked against one hub, the set that has the shingle earliest:
as many checks as members, and copies that differ little from an original end in its component. Tiles that then
lie in one component are done. In all others the sets outside of the tile's largest component are held against
all sets of other components, in blocks of about ``BLOCK`` sets that are compared as matrices, so a tile of any
size is spread over many tasks. Nothing is capped or sampled; every link between different texts is in a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .arrays import FOLDED_VALUES, PrefixHash, chunks, mix, owners, words
from .components import components

WIDTH = 3
#: Sets of fewer shingles have no partner other than an equal set.
LEAST = 9
#: Hashed words whose occurrences are counted; a power of two.
SLOTS = 1 << 17
_SLOT_SHIFT = np.uint64(64 - 17)
#: Sets in a block of a tile, on average at most.
BLOCK = 256


def needed(a, b):
    """Common shingles that sets of these sizes must have: 100 * common >= 90 * union."""
    return (9 * (a + b) + 18) // 19


def bands(limit: int) -> np.ndarray:
    """Least size of each band, up to a size; a set's partners are at most one band away."""
    edges = [LEAST]
    while edges[-1] <= limit:
        edges.append(edges[-1] * 10 // 9 + 1)
    return np.array(edges, np.int64)


_EDGES = bands(1 << 40)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))


def word_levels(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Quarter octaves of the occurrences of all words that share a hash slot, one byte a slot."""

    def run(batches):
        total = np.zeros(SLOTS, np.int64)
        for _, data, offsets in chunks(batches, "body"):
            starts, ends, _ = words(data, offsets)
            h = PrefixHash(data, FOLDED_VALUES).of(starts, ends)
            total += np.bincount((h >> _SLOT_SHIFT).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    rows = docs.select(F.col(text_col).alias("body")).mapInArrow(run, "slot int, n bigint")
    found = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(SLOTS, np.uint8)
    levels[found.column("slot").to_numpy()] = np.log2(found.column("n").to_numpy()) * 4
    return levels


class Shingles:
    """Distinct shingle hashes of the texts of a chunk, sorted by text and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, levels: np.ndarray | None = None):
        starts, ends, at = words(data, offsets)
        h = PrefixHash(data, FOLDED_VALUES).of(starts, ends)
        count = np.diff(at)
        owner = owners(at)
        first = np.flatnonzero(np.arange(len(h)) + WIDTH <= at[1:][owner]) if len(h) else np.zeros(0, np.int64)
        value, text = np.zeros(len(first), np.uint64) + np.uint64(WIDTH), owner[first]
        for k in range(WIDTH):
            value = mix(value * np.uint64(31) + h[first + k])
        short = np.flatnonzero((count > 0) & (count < WIDTH))
        if len(short):
            whole = count[short].astype(np.uint64)
            for k in range(WIDTH - 1):
                more = count[short] > k
                whole[more] = mix(whole[more] * np.uint64(31) + h[at[short][more] + k])
            value, text = np.concatenate([value, whole]), np.concatenate([text, short])
            first = np.concatenate([first, at[short]])
        order = np.lexsort((value, text))
        value, text = value[order], text[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
        self.value, self.text = value[new], text[new]
        self.at = np.searchsorted(self.text, np.arange(len(offsets)))
        self.size = np.diff(self.at)
        if levels is not None:
            rank = levels[(h >> _SLOT_SHIFT).astype(np.int64)]
            least = rank[first[order][new]]
            for k in range(1, WIDTH):
                least = np.minimum(least, rank[np.minimum(first[order][new] + k, max(0, len(h) - 1))])
            self.level = least

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """128-bit name of each set."""
        out = []
        for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D)):
            total = np.zeros(len(self.value) + 1, np.uint64)
            np.cumsum(mix(self.value ^ salt), out=total[1:])
            out.append((total[self.at[1:]] - total[self.at[:-1]]).view(np.int64))
        return tuple(out)

    def bitmaps(self) -> pa.Array:
        """Bitmaps of 64-bit words, a power of two of them; every shingle flips the bit of its low digits."""
        n = np.maximum(self.size / 2, 64)
        width = np.int64(1) << np.ceil(np.log2(n)).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(width)])
        slot = (self.value & (width[self.text] - 1).astype(np.uint64)).astype(np.int64)
        odd = (np.bincount(base[self.text] + slot, minlength=base[-1]) & 1).astype(np.uint8)
        return pa.ListArray.from_arrays(
            pa.array((base // 64).astype(np.int32)), pa.array(np.packbits(odd, bitorder="little").view(np.int64))
        )

    def prefixes(self) -> pa.Array:
        """The first shingles of each set that a partner may have to share, rarest word first."""
        order = np.lexsort((self.value, self.level, self.text))
        place = np.arange(len(order)) - self.at[self.text]
        take = np.where(self.size >= LEAST, self.size - (9 * self.size + 9) // 10 + 1, 0)
        kept = order[place < take[self.text]]
        at = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(self.value[kept].view(np.int64)))


def signatures(docs: DataFrame, levels: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, set_a, set_b, band, bits, prefix`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for part, data, offsets in chunks(batches, "body"):
            s = Shingles(data, offsets, levels)
            band = np.searchsorted(_EDGES, s.size, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(s.size), *map(pa.array, s.names()),
                 pa.array(band.astype(np.int32)), s.bitmaps(), s.prefixes()],
                names=["doc_id", "n", "set_a", "set_b", "band", "bits", "prefix"],
            )

    return _narrow(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n bigint, set_a bigint, set_b bigint, band int, bits array<bigint>, prefix array<bigint>"
    )


def _matrix(bits: pa.ListArray, rows: np.ndarray, width: int) -> np.ndarray:
    at = bits.offsets.to_numpy()
    flat = bits.values.to_numpy().view(np.uint64)
    return flat[at[rows][:, None] + np.arange(width)]


def _halved(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] ^ bits[:, half:]


def _may_reach(na, nb, differing):
    """True if the bits that differ leave room for the overlap that is asked for."""
    return (na + nb - differing) // 2 >= needed(na, nb)


def bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose bitmaps allow enough common shingles."""
    side = classes.select("rep", "n", "bits")
    one = side.select(F.col("rep").alias("a_id"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    two = side.select(F.col("rep").alias("b_id"), F.col("n").alias("b_n"), F.col("bits").alias("b_bits"))
    rows = pairs.join(one, F.col("a") == F.col("a_id")).join(two, F.col("b") == F.col("b_id")).select(
        "a", "b", "a_n", "b_n", "a_bits", "b_bits"
    )
    kind = dict(rows.dtypes)["a"]

    def run(batches):
        for batch in batches:
            a, b = (pa.concat_arrays([batch.column(c)]) for c in ("a_bits", "b_bits"))
            na, nb = (batch.column(c).to_numpy() for c in ("a_n", "b_n"))
            wa, wb = (np.diff(x.offsets.to_numpy()) for x in (a, b))
            keep = np.zeros(batch.num_rows, bool)
            for u, v in {*zip(wa.tolist(), wb.tolist(), strict=True)}:
                at = np.flatnonzero((wa == u) & (wb == v))
                x, y = _matrix(a, at, u), _matrix(b, at, v)
                while x.shape[1] > y.shape[1]:
                    x = _halved(x)
                while y.shape[1] > x.shape[1]:
                    y = _halved(y)
                keep[at] = _may_reach(na[at], nb[at], np.bitwise_count(x ^ y).sum(1, dtype=np.int64))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def full_sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, s``: sorted sets of the wanted classes, from their texts."""
    names = classes.join(wanted.select(F.col("rep").alias("w")), F.col("rep") == F.col("w"), "left_semi").select(
        "rep", "set_a", "set_b"
    )
    found = _narrow(docs, id_col, text_col).join(names, F.col("doc_id") == F.col("rep")).select(
        "rep", "set_a", "set_b", "body"
    )
    kind = dict(found.dtypes)["rep"]

    def run(batches):
        for part, data, offsets in chunks(batches, "body"):
            s = Shingles(data, offsets)
            a, b = s.names()
            own = (a == part.column("set_a").to_numpy()) & (b == part.column("set_b").to_numpy())
            listed = pa.ListArray.from_arrays(pa.array(s.at.astype(np.int32)), pa.array(s.value.view(np.int64)))
            sets = pa.RecordBatch.from_arrays([part.column("rep"), listed], names=["rep", "s"])
            yield sets.filter(pa.array(own))

    # a class's text may stand in several rows of one id
    return found.mapInArrow(run, f"rep {kind}, s array<bigint>").dropDuplicates(["rep", "s"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose sorted sets have enough shingles in common."""
    left = sets.select(F.col("rep").alias("a_id"), F.col("s").alias("a_set"))
    right = sets.select(F.col("rep").alias("b_id"), F.col("s").alias("b_set"))
    rows = pairs.join(right, F.col("b") == F.col("b_id")).join(left, F.col("a") == F.col("a_id")).select(
        "a", "b", "a_set", "b_set"
    )
    kind = dict(rows.dtypes)["a"]

    def run(batches):
        for batch in batches:
            a, b = (pa.concat_arrays([batch.column(c)]) for c in ("a_set", "b_set"))
            (ao, av), (bo, bv) = ((x.offsets.to_numpy(), x.values.to_numpy().view(np.uint64)) for x in (a, b))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = av[ao[i] : ao[i + 1]], bv[bo[i] : bo[i + 1]]
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep[i] = np.count_nonzero(y[at] == x) >= needed(len(x), len(y))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return rows.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def postings(classes: DataFrame) -> DataFrame:
    """``h, tile, rep, n, at`` for every shared prefix shingle and both tiles of the set's band."""
    rows = classes.where(f"n >= {LEAST}").select("rep", "n", "band", F.posexplode("prefix").alias("at", "h"))
    shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("h").alias("k"))
    met = rows.join(shared, F.col("h") == F.col("k"), "left_semi")
    return met.select("h", F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("tile"), "rep", "n", "at")


def hub_pairs(rows: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of every set with the hub of its tile, where sizes and places allow a link."""
    hubs = rows.groupBy("h", "tile").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("at", "rep", "n")).alias("hub")
    ).where("c > 1").select(F.col("h").alias("hh"), F.col("tile").alias("ht"), "hub")
    need = F.expr("(9 * (n + hub.n) + 18) div 19")
    return rows.join(hubs, (F.col("h") == F.col("hh")) & (F.col("tile") == F.col("ht"))).where(
        (F.col("rep") != F.col("hub.rep")) & (F.col("at") <= F.col("n") - need)
        & (F.col("hub.at") <= F.col("hub.n") - need)
    ).select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()


def tile_pairs(rows: DataFrame, label: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of different components that share a tile and pass the bounds of place, size and bits.

    Members of a tile are dealt to blocks by hash; a task compares two blocks as matrices."""
    placed = rows.join(label, F.col("rep") == F.col("node"), "left").select(
        "h", "tile", "rep", "n", "at", F.coalesce("label", "rep").alias("comp")
    )
    by_comp = placed.groupBy("h", "tile", "comp").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("low"))
    mixed = by_comp.groupBy("h", "tile").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("c").alias("c"), F.min("low").alias("low"),
        F.max(F.struct("c", "comp")).alias("top"),
    ).where("comps > 1").select(
        F.col("h").alias("hh"), F.col("tile").alias("ht"), F.col("top.comp").alias("main"), "low",
        F.ceil(F.col("c") / BLOCK).cast("int").alias("parts"),
    )
    # no set of the tile can ask for less than its smallest one does
    need = F.expr("(9 * (n + greatest(low, (9 * n + 9) div 10)) + 18) div 19")
    open_rows = placed.join(mixed, (F.col("h") == F.col("hh")) & (F.col("tile") == F.col("ht"))).where(
        F.col("at") <= F.col("n") - need
    ).select(
        "h", "tile", "parts", "rep", "n", "at", "comp", (F.col("comp") != F.col("main")).alias("rest"),
        F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("block"),
    )
    bits = classes.select(F.col("rep").alias("c_rep"), "bits")
    full = open_rows.join(bits, F.col("rep") == F.col("c_rep")).select(
        "h", "tile", "parts", "block", F.struct("rep", "comp", "n", "at", "rest", "bits").alias("m")
    )
    blocks = stored(full.groupBy("h", "tile", "parts", "block").agg(F.collect_list("m").alias("m")), "tile-blocks")
    alone = blocks.where((F.col("parts") == 1) & (F.size("m") > 1)).select(F.col("m").alias("few"), F.col("m").alias("many"))
    split = blocks.where("parts > 1")
    one = split.where(F.exists("m", lambda x: x["rest"])).select("h", "tile", F.col("m").alias("few"))
    two = split.select(F.col("h").alias("h2"), F.col("tile").alias("t2"), F.col("m").alias("many"))
    both = alone.union(
        one.join(two, (F.col("h") == F.col("h2")) & (F.col("tile") == F.col("t2"))).select("few", "many")
    )
    kind = dict(classes.dtypes)["rep"]

    def members(listed: pa.ListArray, i: int):
        at = listed.offsets.to_numpy()
        m = listed.values.slice(at[i], at[i + 1] - at[i])
        rest = m.field("rest").to_numpy(zero_copy_only=False)
        return m.field("rep"), m.field("comp"), m.field("n").to_numpy(), m.field("at").to_numpy(), m.field("bits"), rest

    def run(batches):
        for batch in batches:
            few, many = (pa.concat_arrays([batch.column(c)]) for c in ("few", "many"))
            left, right = [], []
            for i in range(batch.num_rows):
                ar, ac, an, aa, ab, rest = members(few, i)
                br, bc, bn, ba, bb, _ = members(many, i)
                need = needed(an[:, None], bn[None, :])
                code = pa.concat_arrays([ac, bc]).dictionary_encode().indices.to_numpy()
                ok = (code[: len(an), None] != code[None, len(an) :])
                ok &= rest[:, None] & (aa[:, None] <= an[:, None] - need) & (ba[None, :] <= bn[None, :] - need)
                x, y = np.nonzero(ok)
                if not len(x):
                    continue
                wa, wb = (np.diff(z.offsets.to_numpy()) for z in (ab, bb))
                keep = np.zeros(len(x), bool)
                for u, v in {*zip(wa[x].tolist(), wb[y].tolist(), strict=True)}:
                    own = np.flatnonzero((wa[x] == u) & (wb[y] == v))
                    p, q = _matrix(ab, x[own], u), _matrix(bb, y[own], v)
                    while p.shape[1] > q.shape[1]:
                        p = _halved(p)
                    while q.shape[1] > p.shape[1]:
                        q = _halved(q)
                    differing = np.bitwise_count(p ^ q).sum(1, dtype=np.int64)
                    keep[own] = _may_reach(an[x[own]], bn[y[own]], differing)
                left.append(ar.take(pa.array(x[keep])))
                right.append(br.take(pa.array(y[keep])))
            if left:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(left), pa.concat_arrays(right)], names=["x", "y"])

    return both.mapInArrow(run, f"x {kind}, y {kind}").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    ).distinct()


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row.

    Null and empty texts, and texts without words, have an empty set and are linked with nothing: their
    component is their own id. Rows with equal ids and words are one document, so all of them share a component
    even if their texts differ. A row with a null id is linked with nothing and its component is null. Repeated
    rows repeat their result, ties go to the least id, an empty table gives an empty result, other columns are
    ignored. A very long text is worked on as a whole, with some sixty bytes of memory a byte."""
    levels = word_levels(docs, text_col)
    sig = stored(signatures(docs, levels, id_col, text_col), "tile-signatures")
    by_set = ["set_a", "set_b", "n"]
    classes = stored(
        sig.where("n > 0 and doc_id is not null").groupBy(*by_set).agg(
            F.min("doc_id").alias("rep"), F.min_by(F.struct("band", "bits", "prefix"), "doc_id").alias("v")
        ).select("rep", *by_set, "v.band", "v.bits", "v.prefix"),
        "tile-classes",
    )
    rows = stored(postings(classes), "tile-postings")
    near = stored(bounded(hub_pairs(rows), classes), "tile-near")
    ends = near.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    links = stored(confirmed(near, full_sets(docs, ends, classes, id_col, text_col)), "tile-links")
    more = stored(tile_pairs(rows, components(links), classes), "tile-more")
    ends = more.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    links = links.union(confirmed(more, full_sets(docs, ends, classes, id_col, text_col)))
    rep_of = classes.select(*[F.col(c).alias(f"c_{c}") for c in by_set], "rep")
    same_set = F.col("doc_id").isNotNull()
    for c in by_set:
        same_set = same_set & (F.col(c) == F.col(f"c_{c}"))
    member = stored(sig.select("doc_id", *by_set).join(rep_of, same_set, "left").select("doc_id", "n", "rep"), "tile-rows")
    reused = member.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
    reused = reused.where("lo <> hi").select(F.col("doc_id").alias("r"))
    bridges = member.join(reused, F.col("doc_id") == F.col("r"), "left_semi").where("rep is not null").select("doc_id", "rep")
    label = components(links.union(bridges.toDF("a", "b")))
    return member.join(label, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep", "doc_id").alias("component_id")
    )
