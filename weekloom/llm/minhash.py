"""Near duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text's set is its distinct 5-word shingles (all its
words if there are fewer), as 64-bit hashes. Texts with equal sets form a class, and classes are compared.

**Keys.** ``COLLECTIONS`` small collections of ``PER_COLLECTION`` minhashes each are hashed; a table key is a
*pair* of collection values. 16 collections of 2 give 120 tables of four minhashes from 32 minhashes instead
of 480. Texts with similarity 0.75 share a collection value with probability 0.56 and miss all 120 tables only
if fewer than two of 16 agree (4 in 100,000). Keys are formed only from collection values that some
other class has as well, so a text without relatives costs 16 narrow rows.

**Links.** In a bucket every class is checked against the class of the bucket's least id, on full sets: as many checks as
members. Confirmed links are joined to components. Buckets that then lie in one component are done. The
classes of all other buckets go through an exact prefix filter: two sets with similarity 0.75 share one of
the n - ceil(0.75 n) + 1 rarest shingles of each, so a join on those, between different components only,
finds every link that is left, however large the bucket. No bucket is capped or sampled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import stored
from .arrays import FOLDED_VALUES, PrefixHash, chunks, mix, words
from .components import components

WIDTH = 5
PERCENT = 75
COLLECTIONS, PER_COLLECTION = 16, 2
#: Bytes of text a task works on at once.
CHUNK = 1 << 19
_FACTORS = mix(np.arange(1, COLLECTIONS * PER_COLLECTION + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, ends, at = words(data, offsets)
    h = PrefixHash(data, FOLDED_VALUES).of(starts, ends)
    n = len(h)
    total = np.full(max(0, n - width + 1), width, np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(31) + h[k : n - width + 1 + k])
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            sets.append(np.unique(total[a : b - width + 1]))
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                one = mix(one * np.uint64(31) + h[k])
            sets.append(one)
        else:
            sets.append(h[:0])
    return sets


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b`` (128-bit name of the set) and ``bands``, the collection values."""
    kind = docs.schema[id_col].dataType.simpleString()
    number = np.arange(COLLECTIONS, dtype=np.uint64)

    def run(batches):
        for part, data, offsets in chunks(batches, "body", CHUNK):
            sets = shingle_sets(data, offsets)
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            first, second = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            bands = np.zeros((len(full), COLLECTIONS), np.uint64)
            if len(full):
                every = np.concatenate([sets[i] for i in full])
                begin = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                first[full] = np.add.reduceat(mix(every), begin)
                second[full] = np.add.reduceat(mix(every ^ np.uint64(0x5851F42D4C957F2D)), begin)
                least = [np.minimum.reduceat(every * f, begin) for f in _FACTORS]
                for k in range(PER_COLLECTION):
                    own = np.column_stack(least[k::PER_COLLECTION])
                    bands = mix(bands + own * np.uint64(2) + number)
            empty = pa.nulls(len(sets), pa.list_(pa.int64()))
            where = np.full(len(sets), -1)
            where[full] = np.arange(len(full))
            flat = pa.array(bands.view(np.int64).ravel())
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (len(full) + 1) * COLLECTIONS, COLLECTIONS, dtype=np.int32)), flat
            )
            taken = listed.take(pa.array(np.maximum(where, 0), mask=where < 0)) if len(full) else empty
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size), pa.array(first.view(np.int64)),
                 pa.array(second.view(np.int64)), taken],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
    )


def table_keys(classes: DataFrame) -> DataFrame:
    """``key, rep, first, n`` of the tables in which a class (``rep, first, n, bands``) may meet another one."""
    values = classes.select("rep", "first", "n", F.posexplode("bands").alias("i", "u"))
    shared = values.groupBy("u").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("u").alias("s"))
    met = (
        values.join(shared, F.col("u") == F.col("s"), "left_semi")
        .groupBy("rep", "first", "n").agg(F.sort_array(F.collect_list(F.struct("i", "u"))).alias("m")).where("size(m) > 1")
    )
    pairs = F.flatten(
        F.transform("m", lambda x: F.transform(
            F.filter("m", lambda y: y["i"] > x["i"]), lambda y: F.xxhash64(x["u"], y["u"])))
    )
    return met.select(F.explode(pairs).alias("key"), "rep", "first", "n")


def _similar_size(a: str, b: str):
    return (100 * F.least(a, b)) >= (PERCENT * F.greatest(a, b))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a_id"), F.col("s").alias("a_set"))
    right = sets.select(F.col("rep").alias("b_id"), F.col("s").alias("b_set"))
    joined = pairs.join(right, F.col("b") == F.col("b_id")).join(left, F.col("a") == F.col("a_id"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    counted = joined.select("a", "b", common.alias("c"), (F.size("a_set") + F.size("b_set")).alias("t"))
    return counted.where(100 * F.col("c") >= PERCENT * (F.col("t") - F.col("c"))).select("a", "b")


def rare_shingle_pairs(sets: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of different components that share one of each other's rarest shingles.

    ``sets``: ``rep, comp, s``. Only shingles that occur in two components are joined, and one side leaves
    out the shingle's most frequent component, so a large component is never paired with itself. A pair counts
    only if the shingle is early enough in both orders for the common shingles the two sizes ask for."""
    rows = sets.select("rep", "comp", F.size("s").alias("n"), F.explode("s").alias("h"))
    seen = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    ranked = (
        rows.join(seen.select(F.col("h").alias("k"), "df"), F.col("h") == F.col("k"))
        .groupBy("rep", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    )
    take = F.col("n") - F.ceil(F.col("n") * PERCENT / 100).cast("int") + 1
    prefix = ranked.select("rep", "comp", "n", F.posexplode(F.slice("o", F.lit(1), take)).alias("at", "x")).select(
        "rep", "comp", "n", "at", F.col("x.h").alias("h")
    )
    prefix = stored(prefix, "near-prefix")
    by_comp = prefix.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = by_comp.groupBy("h").agg(
        F.count(F.lit(1)).alias("comps"), F.max(F.struct("c", "comp")).alias("top")
    ).where("comps > 1").select(F.col("h").alias("k"), F.col("top.comp").alias("main"))
    rows = prefix.join(mixed, F.col("h") == F.col("k")).select("h", "rep", "comp", "n", "at", "main")
    few = rows.where("comp <> main").select(
        F.col("h").alias("h2"), F.col("rep").alias("rep2"), F.col("comp").alias("comp2"),
        F.col("n").alias("n2"), F.col("at").alias("at2"),
    )
    # 75 % similarity means at least 3/7 of both sizes in common, which bounds the places of the first one
    common = F.expr("(3 * (n + n2) + 6) div 7")
    early = (F.col("at") <= F.col("n") - common) & (F.col("at2") <= F.col("n2") - common)
    return rows.join(
        few,
        (F.col("h") == F.col("h2")) & (F.col("comp") != F.col("comp2")) & _similar_size("n", "n2") & early,
    ).select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


#: Columns that name a set of shingles.
BY_SET = ["set_a", "set_b", "n_shingles"]


def class_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with the class of their text, classes with their least id, and links between near-duplicate classes.

    A class (``rep``, a 64-bit name) is a set of shingles: texts, not ids, are linked. Rows without words or
    without an id have no class."""
    sig = stored(signatures(docs, id_col, text_col), "near-signatures")
    named = sig.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        named.groupBy(*BY_SET).agg(F.min("doc_id").alias("first"), F.min_by("bands", "doc_id").alias("bands"))
        .withColumn("rep", F.col("set_a")),
        "near-classes",
    )
    keys = table_keys(classes.select("rep", "first", F.col("n_shingles").alias("n"), "bands"))
    hubs = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("first", "rep", "n")).alias("hub")).where("c > 1")
    met = stored(
        keys.join(hubs.select(F.col("key").alias("k"), "hub"), F.col("key") == F.col("k"))
        .select("key", "rep", "n", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")),
        "near-buckets",
    )
    wanted = met.select("rep").distinct()
    sets = stored(_sets_of(docs, wanted, classes, id_col, text_col), "near-sets")
    pairs = met.where((F.col("hub") != F.col("rep")) & _similar_size("n", "hub_n")).select(
        F.col("hub").alias("a"), F.col("rep").alias("b")
    ).distinct()
    links = stored(confirmed(pairs, sets), "near-links")
    label = components(links)
    placed = met.select("key", "rep").join(label, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("comp")
    )
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    open_reps = placed.join(split.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi").select(
        F.col("rep").alias("r"), "comp"
    ).distinct()
    open_sets = stored(sets.join(open_reps, F.col("rep") == F.col("r")).select("rep", "comp", "s"), "near-open")
    links = stored(links.union(confirmed(rare_shingle_pairs(open_sets), sets)), "near-links")
    own = classes.select(*[F.col(c).alias(f"c_{c}") for c in BY_SET], "rep")
    same_set = F.col("doc_id").isNotNull()
    for c in BY_SET:
        same_set = same_set & (F.col(c) == F.col(f"c_{c}"))
    rows = stored(sig.select("doc_id", *BY_SET).join(own, same_set, "left").select("doc_id", "n_shingles", "rep"), "near-rows")
    return rows, classes.select("rep", "first"), links


def _least(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, comp_id, comp_rep``: for every linked class the least id of its component, and the class that has it."""
    label = components(links)
    known = label.join(classes, F.col("node") == F.col("rep"))
    least = known.groupBy(F.col("label").alias("of")).agg(F.min(F.struct("first", "rep")).alias("least"))
    return label.join(least, F.col("label") == F.col("of")).select(
        "node", F.col("least.first").alias("comp_id"), F.col("least.rep").alias("comp_rep")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row.

    Null and empty texts, and texts without words, have an empty set and are linked with nothing. Rows with
    equal ids are one document: their texts are linked, so an id has one component (rows without words keep their
    own id). A row with a null id is no one's duplicate: its component is null and it is kept. Repeated rows
    repeat their verdict. An empty table gives an empty result; other columns are ignored. A very long text is
    worked on as a whole, in some hundred bytes of memory a byte."""
    rows, classes, links = class_links(docs, id_col, text_col)
    named = rows.where("rep is not null")
    reused = named.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    bridges = named.join(reused.select(F.col("doc_id").alias("r"), "lo"), F.col("doc_id") == F.col("r")).select(
        F.col("lo").alias("a"), F.col("rep").alias("b")
    )
    least = _least(classes, links.union(bridges))
    first = classes.select(F.col("rep").alias("f_rep"), "first")
    found = rows.join(first, F.col("rep") == F.col("f_rep"), "left").join(least, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp_id", "first", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one text of each group of near duplicates: the one of the least id.

    Groups are groups of texts. An id that stands for several texts loses those that have a representative elsewhere
    and keeps the others, so no text is lost altogether. Rows without words or without an id stay."""
    rows, classes, links = class_links(docs, id_col, text_col)
    least = _least(classes, links)
    first = classes.select(F.col("rep").alias("f_rep"), "first")
    judged = rows.where("rep is not null").join(first, F.col("rep") == F.col("f_rep")).join(
        least, F.col("rep") == F.col("node"), "left"
    )
    stays = (F.col("doc_id") == F.coalesce("comp_id", "first")) & (F.col("rep") == F.coalesce("comp_rep", "rep"))
    judged = judged.select("doc_id", "rep", stays.alias("stays"))
    whole = rows.where("rep is null and doc_id is not null").select("doc_id", F.lit(0).alias("rep"), F.lit(True).alias("stays"))
    ids = judged.union(whole).groupBy(F.col("doc_id").alias("_near_id")).agg(
        F.bool_or("stays").alias("some"), F.bool_and("stays").alias("all")
    )
    ids = stored(ids.where("not all"), "near-gone")
    mine = F.col(id_col) == F.col("_near_id")
    clear = docs.join(ids.select("_near_id"), mine, "left_anti")
    if ids.where("some").isEmpty():
        return clear
    # ids with texts of both kinds; only their rows are named again
    mixed = docs.join(ids.where("some").select("_near_id"), mine, "left_semi")
    names = signatures(mixed, id_col, text_col).where("n_shingles > 0").select("doc_id", "set_a").distinct()
    gone = names.join(judged.where("not stays").select(F.col("doc_id").alias("g"), F.col("rep").alias("gr")),
                      (F.col("doc_id") == F.col("g")) & (F.col("set_a") == F.col("gr")), "left_semi")
    return clear.unionByName(_without_sets(mixed, gone, id_col, text_col))


def _without_sets(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose id and set are not among ``doc_id, set_a``."""
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_near_set", T.LongType())])

    def run(batches):
        for part, data, offsets in chunks(batches, text_col, CHUNK):
            name = [int(np.add.reduce(mix(s)).view(np.int64)) if len(s) else None for s in shingle_sets(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(name, pa.int64())], names=[*part.schema.names, "_near_set"]
            )

    listed = gone.select(F.col("doc_id").alias("_g_id"), F.col("set_a").alias("_g_set"))
    named = docs.mapInArrow(run, schema)
    return named.join(
        listed, (F.col(id_col) == F.col("_g_id")) & (F.col("_near_set") == F.col("_g_set")), "left_anti"
    ).select(*columns)


def _sets_of(docs: DataFrame, wanted: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, s``: full sets of the wanted classes, from their texts. Rows that repeat a set are left out once
    seen in the task; any left over only repeat links."""
    names = classes.join(wanted.select(F.col("rep").alias("w")), F.col("rep") == F.col("w"), "left_semi").select(
        "rep", "first", "set_a", "set_b"
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body")).where("doc_id is not null")
    found = texts.join(names, F.col("doc_id") == F.col("first")).select("rep", "set_a", "set_b", "body")

    def run(batches):
        seen = set()
        for part, data, offsets in chunks(batches, "body", CHUNK):
            sets = shingle_sets(data, offsets)
            name = np.array([np.add.reduce(mix(s)) if len(s) else np.uint64(0) for s in sets], np.uint64)
            own = []
            for i in np.flatnonzero(name.view(np.int64) == part.column("set_a").to_numpy()).tolist():
                known = (part.column("rep")[i].as_py(), int(name[i]))
                if known not in seen:
                    seen.add(known)
                    own.append(i)
            if own:
                values = [sets[i].view(np.int64) for i in own]
                at = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep").take(pa.array(own)),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(values)))],
                    names=["rep", "s"],
                )

    return found.mapInArrow(run, "rep bigint, s array<bigint>")
