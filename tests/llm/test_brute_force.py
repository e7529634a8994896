"""Queries that SQL cannot express, against brute force, exact round trips or held-out labels."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

import corpus_pipeline
from weekloom.llm import chat_format, decontaminate, minhash, packing, pii, suffix_dedup, tokens
from weekloom.llm import queries as llm
from weekloom.llm.suffix_array import permuted_lcp, suffix_array

from .frames import near_components, repeated, shingles


@pytest.fixture(scope="module")
def texts(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def test_op1_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = llm.op1_quality_model(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_op9_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = llm.op9_language(spark, folder).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_op2_counts_every_window(spark, folder, texts, monkeypatch):
    want = sorted(repeated(texts))
    for hot in (1000, 3):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = sorted(tuple(r) for r in llm.op2_repeated_bytes(spark, folder).collect())
        assert got == want


def test_op2_planted(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(random.randint(2, 9)))
    make = lambda n: " ".join(word() for _ in range(n))
    part = make(60)
    rows = [(i, make(40) + part[: 150 + 5 * i] + make(20)) for i in range(30)]
    rows += [(50, "ab" * 300), (51, "x" * 199), (52, "y" * 201), (53, part + make(3) + part), (54, "é" * 150 + make(9))]
    rows += [(60, "z" * 199 + "!"), (61, "z" * 199 + "!"), (70, "q" * 200)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_bytes(df).collect())
    assert got == sorted(repeated(rows))


def test_op2_periods(spark):
    """Lines repeated within one document only, with periods around the reach of an anchor."""
    random.seed(6)
    line = lambda n: "".join(random.choice("abcdefghij ") for _ in range(n - 1)) + "\n"
    rows = [(100 * p + k, line(50) + line(p) * k + line(70)) for p in range(97, 106) for k in (3, 6)]
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(repeated(rows))


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=80), st.integers(1, 6))
def test_suffix_array(data, letters):
    data = bytes(b % letters for b in data)
    data += data[: len(data) // 2]
    want = sorted(range(len(data)), key=lambda i: data[i:])
    x = np.frombuffer(data, np.uint8)
    assert suffix_array(x.astype(np.int64) + 1).tolist() == want
    lcp, before = permuted_lcp(x, np.array(want))
    for i, j in zip(want[1:], want[:-1], strict=True):
        n = 0
        while i + n < len(data) and j + n < len(data) and data[i + n] == data[j + n]:
            n += 1
        assert (lcp[i], before[i]) == (n, j)


def test_op4_equals_library(spark, folder, texts):
    pieces = tokens.vocabulary(public_tokenizers.path(tokens.UNIGRAM))
    bytes_ = [(f"<0x{i:02X}>", -5e9) for i in range(256)]
    least = min(s for _, s in pieces)
    library = Tokenizer(models.Unigram([("<unk>", least), *pieces, *[(b, least) for b, _ in bytes_]], 0, byte_fallback=True))
    got = {r.doc_id: r.n_tokens for r in llm.op4_token_count(spark, folder).collect()}
    for i, t in texts[:80]:
        assert got[i] == len(library.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids)
    counter = tokens.unigram(public_tokenizers.path(tokens.UNIGRAM))
    for t in ("a", " ", "  b  ", "héllo\nwörld", "日本 語", "aaaaaaaa", "\x00\x01"):
        assert counter(t)[0] == len(library.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids)
    whole = tokens.UnigramCounter([(c, -1.0) for c in "ab▁"] + [("a▁b", -1.5), ("▁a", -1.5)])
    assert not whole.cuts and whole("a b a") == (3, -4.0)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(" \n\t.,'éa1Z-_<|>\u00a0\u2003\x1c\x85\U0001f600"), max_size=40) | st.sampled_from(["x <|endoftext|> y", "don't  go", "a \n b"]))
def test_op5_ids_equal_library(text):
    library = Tokenizer.from_file(public_tokenizers.path(tokens.BPE[0]))
    ids = tokens.bpe(*llm.bpe_files())(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_op5_places(spark, folder, texts):
    got = llm.op5_packing(spark, folder).toPandas()
    library = Tokenizer.from_file(public_tokenizers.path(tokens.BPE[0]))
    own = {i: g.sort_values("piece") for i, g in got.groupby("doc_id")}
    for i, t in texts[:40]:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        g = own[i]
        assert g.length.sum() == len(ids) and (g.length.iloc[1:] == 2048).all()
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(g.start, g.length, strict=True)] == g.ids_crc32.tolist()
    ordered = got.sort_values(["sequence_id", "offset"])
    assert ((ordered.groupby("sequence_id").length.cumsum() - ordered.length) == ordered.offset).all()
    least = -(-got.length.sum() // 2048)
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= 1.01 * least + 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_plan_holds_the_histogram(histogram):
    held = Counter()
    for config, k in packing.plan(histogram, 64).bins:
        assert sum(config) <= 64
        for l in config:
            held[l] += k
    assert held == Counter(histogram)


def test_op6_patterns(spark, folder, texts):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def plain(text):
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text):
                d = re.sub("[^0-9]", "", m[0])
                if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                    continue
                if kind == "card" and not (16 <= len(d) <= 19 and pii.luhn(d)):
                    continue
                if kind == "phone" and not 8 <= len(d) <= 15:
                    continue
                yield kind, m.start(), m.end()

    random.seed(2)
    for _ in range(4000):
        t = "".join(random.choice("a0.1@+-2 ()5%é4\n") for _ in range(random.randint(0, 40)))
        assert pii.base_spans(t) == list(plain(t))
    got = {r.doc_id: r for r in pii.personal_data(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    for i, t in texts:
        want = list(plain(t))
        assert got[i].base_spans == pii.joined(want)
        assert set(map(pii.joined, ([s] for s in want))) <= set(got[i].spans.split(",")) | {""}
        assert (got[i].n_email, got[i].n_phone) == tuple(sum(s[0] == k for s in want) for k in ("email", "phone"))


def test_op6_random_field():
    field = pii.fit_field(pii.training_rows())
    rows = pii.training_rows(3, seed=99)
    found = pii.find_spans([t for t, _ in rows], field)
    right = sum(sorted(s) == sorted(every) for (_, s), (_, every) in zip(rows, found, strict=True))
    assert right >= 0.97 * len(rows)
    scores = np.random.default_rng(0).normal(size=(4, 3, len(pii.TAGS)))
    tags = pii.viterbi(scores, field.transition)
    for s, t in zip(scores, tags, strict=True):
        best = max(
            ((s[0, a] + field.transition[a, b] + s[1, b] + field.transition[b, c] + s[2, c], (a, b, c))
             for a in np.flatnonzero(pii._STARTS) for b in np.flatnonzero(pii._OK[a]) for c in np.flatnonzero(pii._OK[b])))
        assert tuple(t) == best[1]


def test_op6_neighbours_in_long_texts():
    """The same words have the same features in a short and in a long text, however far their neighbours are."""
    prose = "plain words without any sign " * 40
    sentences = [t for t, _ in pii.training_rows(1)][:200]
    for n in (1, 79, 81, 200):
        sentences += [f"my key is{' ' * n}ab12cd34ef56gh now", f"key is ab12cd34ef56gh{' ' * n}now", f"my key {'x' * n}7 ok"]
    for t in sentences:
        short = f"so it is {t} and on"
        long = prose + short + " " + prose
        assert [r.features for r in pii.runs(long)] == [r.features for r in pii.runs(short)]
        assert [[a - len(prose) for a in r.starts] for r in pii.runs(long)] == [r.starts for r in pii.runs(short)]


def test_op7_components(spark, folder, texts):
    want = near_components(texts)
    got = llm.op7_near_duplicates(spark, folder).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingles(dict(texts)[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_op7_chain_and_common_passage(spark):
    random.seed(8)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(200)]
    rows = []
    for i in range(40):  # a chain: each text drops the first six words of the one before
        rows.append((i, " ".join(base[6 * (i // 2) :] + base[: 3 * (i % 2)])))
    passage = [word() for _ in range(80)]
    rows += [(100 + i, " ".join([word() for _ in range(30)] + passage)) for i in range(120)]
    rows += [(300 + i, " ".join(passage + [word() for _ in range(i % 9)])) for i in range(60)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == near_components(rows)


def test_op8_pairs(spark):
    folder = "/root/testdata/sf0.01"
    items = {r.item_id: r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {(r.doc_id, r.item_id) for r in llm.op8_decontaminate(spark, folder).collect()}
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = {i: {tuple(w[k : k + 8]) for k in range(len(w) - 7)} for i, w in ((i, words(t)) for i, t in items.items())}
    exact, near = set(), set()
    for r in docs:
        w = words(r.text)
        own = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        exact |= {(r.doc_id, i) for i, t in items.items() if t in r.text}
        near |= {(r.doc_id, i) for i, g in grams.items() if len(g & own) >= 0.3 * len(g)}
    assert exact <= got <= near


def test_op8_scores_equal_exhaustive_search(spark):
    random.seed(3)
    vocabulary = ["w%d" % i for i in range(60)]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(random.randint(6, 25))), None) for i in range(30)]
    import pyarrow as pa

    index = decontaminate.ItemIndex(items)
    texts = [" ".join(random.choice(vocabulary) for _ in range(20)) + " " + random.choice(items)[1] for _ in range(60)]
    got = {(t, i) for t, i, *_ in index.search(pa.array(texts))}
    want = set()
    for n, t in enumerate(texts):
        w = t.split()
        for lo in range(0, len(w), index.stride):
            own = set(w[lo : lo + 2 * index.stride])
            seq = {tuple(w[lo : lo + 2 * index.stride][k : k + 3]) for k in range(len(w[lo : lo + 2 * index.stride]) - 2)}
            for b in index.blocks:
                for row, item in enumerate(b.items):
                    h, _ = decontaminate.term_hashes(pa.array(sorted(own)))
                    s = b.impacts[np.isin(index.vocabulary[b.terms], h), row].sum()
                    q = items[item][1].split()
                    cut = len(q) - -(-len(q) // 3)
                    share = lambda x: np.mean([g in seq for g in {tuple(x[k : k + min(3, len(x))]) for k in range(max(1, len(x) - 2))}])
                    if s >= decontaminate.LEAST and share(q[:cut]) >= 0.6 and share(q[cut:]) >= 0.6:
                        want.add((n, int(item)))
    assert got == want and got


def test_op8_near_copies(spark):
    """Planted copies of the shortest and other items: changed words, cut ends, and answers of their own."""
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(7))
    prose = lambda n: " ".join(word() for _ in range(n))
    size = lambda i: 15 + 4 * (i // 4)
    items = [(i, prose(size(i)), [None, "", prose(1), prose(5)][i % 4]) for i in range(40)]

    def changed(text, places):
        return " ".join(word() if k in places else w for k, w in enumerate(text.split()))

    docs, want, answered = [], set(), set()
    for i, text, answer in items:
        n = size(i)
        copies = [text, " ".join(text.split()[: round(0.85 * n)]), " ".join(text.split()[-round(0.85 * n) :])]
        copies += [changed(text, {k}) for k in range(n)]
        copies += [changed(text, set(random.sample(range(n), 2))) for _ in range(20)]
        for copy in copies:
            docs.append((len(docs), f"{prose(20)} {copy} {prose(20)}"))
            want.add((docs[-1][0], i))
        docs.append((len(docs), " ".join(random.sample(text.split(), n))))  # the words alone are no copy
        if answer:
            docs.append((len(docs), f"{prose(9)} {text} {answer} {prose(9)}"))
            answered.add((docs[-1][0], i))
    df = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string, answer string")
    rows = decontaminate.find_leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want | answered
    assert all(r.answer_overlap is None and r.question_overlap >= decontaminate.OVERLAP for r in rows)
    rows = decontaminate.find_leaks(df, bench, answer_col="answer").collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got == {(d, i) for d, i in want if i % 4 < 2} | answered
    assert {(r.doc_id, r.item_id) for r in rows if r.answer_overlap is not None} == answered


def test_op3_native(spark, folder):
    plan = llm.op3_chat_format(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "~1:#"]), st.text(st.sampled_from("\\#< /turn>\n:a"), max_size=14)), max_size=4))
def test_op3_round_trip(spark, turns):
    extra = [("user", "\\\\### a"), ("assistant", "\\</turn>"), ("assistant", "### assistant:\nx\n</turn>\n")]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(turns + extra)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").coalesce(1)
    got = chat_format.read_back(chat_format.format_conversations(df)).first()
    assert [(t.role, t.text) for t in got.turns] == turns + extra
    assert got.loss_text == "".join(t for r, t in turns + extra if r == "assistant")


def test_pipeline(spark):
    """Rows against a plain version of the stages on the same tables."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = [(r.doc_id, r.text) for r in docs if re.search(r"[^\W\d_]", r.text)]
    component = near_components(kept)
    kept = [(i, t) for i, t in kept if component[i] == i and not any(x in t for x in items)]
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:2] == ["doc_id", "piece"]
    rows = got.toPandas()
    ids = set(rows.doc_id)
    # Item copies that are not verbatim may go as well; nothing else may.
    assert ids <= {i for i, _ in kept} and len(kept) - len(ids) <= 0.01 * len(kept)
    encode = tokens.bpe(*llm.bpe_files())
    field = pii.fit_field(pii.training_rows())
    own = {i: g.sort_values("piece") for i, g in rows.groupby("doc_id")}
    for i, t in kept[::25]:
        if i in own:
            clean = pii.mask(t, pii.find_spans([t], field)[0][1])
            data = encode(clean) + bytes(4)
            g = own[i]
            assert [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(g.start, g.length, strict=True)] == g.ids_crc32.tolist()


def test_queries_are_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names and F


def token_lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    pieces = packing.token_pieces(docs, llm.bpe_files())
    return {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}


def test_op5_program_makes_the_plan(spark):
    """The program's own configurations hold nine tenths of the pieces, close to the bound, at any number of pieces."""
    histogram = token_lengths(spark)
    for times in (1, 30, 1000):
        counts = {l: n * times for l, n in histogram.items()}
        found = packing.plan(counts)
        held = Counter()
        for config, k in found.bins:
            assert sum(config) <= 2048
            for l in config:
                held[l] += k
        assert held == Counter(counts)
        short = sum(n for l, n in counts.items() if l < 2048)
        assert found.programmed >= 0.9 * short
        total = sum(k for _, k in found.bins)
        assert found.bound <= total <= found.bound + len(found.bins) and total <= 1.001 * found.bound
        assert found.bound >= -(-sum(l * n for l, n in counts.items()) // 2048)


def test_lower_bound_is_no_more_than_the_best_packing():
    """Against exhaustive search on few pieces, and where sizes alone say too little."""
    rng = np.random.default_rng(8)

    def fewest(pieces: tuple, bins: tuple = ()) -> int:
        if not pieces:
            return len(bins)
        tried = {(*bins[:i], r - pieces[0], *bins[i + 1 :]) for i, r in enumerate(bins) if r >= pieces[0]}
        return min(fewest(pieces[1:], tuple(sorted(b))) for b in [*tried, (*bins, 20 - pieces[0])])

    for _ in range(25):
        pieces = tuple(sorted(rng.integers(1, 21, rng.integers(1, 8)).tolist(), reverse=True))
        found = packing.plan(Counter(pieces), 20)
        best = fewest(pieces)
        assert found.bound <= best <= sum(k for _, k in found.bins) <= best + 1
    assert packing.plan({1100: 50, 1200: 50, 10: 3}).bound == 100
    assert packing.plan({2048: 7}) == ([((2048,), 7)], 7, 0)
    assert packing.plan({}) == ([], 0, 0)


def test_knapsack_equals_enumeration():
    rng = np.random.default_rng(4)
    for _ in range(30):
        items, prices = rng.integers(1, 15, 7), rng.random(7)
        table = packing.Knapsack(items, prices, 20)
        best = max(sum(p for p, x in zip(prices, take, strict=True) if x)
                   for take in itertools.product([0, 1], repeat=7) if sum(items[np.array(take, bool)]) <= 20)
        content = table.content(20)
        assert table.best[20] == pytest.approx(best) and sum(content) <= 20
        assert not Counter(content) - Counter(items.tolist())


def test_op8_pairs_do_not_depend_on_shards(spark, monkeypatch):
    """The same pairs and scores for one shard, two and ten, in one pass over the texts, with and without answers."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").withColumn("answer", F.element_at(F.split("text", " "), -1))
    n = items.count()
    for answer in (None, "answer"):
        found = []
        for size in (n, -(-n // 2), -(-n // 10)):
            monkeypatch.setattr(decontaminate, "SHARD_ITEMS", size)
            leaks = decontaminate.find_leaks(docs, items, answer_col=answer)
            found.append(sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in leaks.collect()))
        assert found[0] == found[1] == found[2] and len(found[0]) > 5
        assert len(decontaminate.item_shards(items)) >= 9
        kept = decontaminate.without_leaks(docs, items, answer_col=answer).count()
        assert kept == docs.count() - len({d for d, _, _ in found[0]})
        monkeypatch.setattr(decontaminate, "PASS_SHARDS", 20)
        plan = decontaminate.find_leaks(docs, items)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1
