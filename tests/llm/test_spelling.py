"""Spelling variants against all pairs."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from weekloom.llm import queries, spelling

from .frames import nothing, odd_documents


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts: dict, factor: int = 10) -> dict:
    words = sorted(counts)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def vocabulary(seed: int, letters: str, size: int) -> dict:
    rng = random.Random(seed)
    counts = {}
    while len(counts) < size:
        if counts and rng.random() < 0.6:
            w = list(rng.choice(list(counts)))
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = rng.choice(letters) * rng.randrange(3)
        else:
            w = rng.choices(letters, k=rng.choice([7, 7, 8, 9, 12, 30]))
        if len(w) >= 7:
            counts["".join(w)] = rng.choice([2, 3, 20, 25, 300, 4000])
    return counts


@pytest.mark.parametrize(("letters", "lists"), [("ab", 100_000), ("ab", 7), ("abcdéü", 100_000), ("abcdéü", 3)])
def test_all_pairs(spark, monkeypatch, letters, lists):
    monkeypatch.setattr(spelling, "LIST", lists)
    counts = vocabulary(len(letters) + lists, letters, 600)
    vocab = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(vocab).collect()}
    assert got == plain(counts) and sum(v[3] for v in got.values()) > 200


def test_chunks_are_cut_between_lists(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELLS", 50)
    counts = vocabulary(8, "abc", 300)
    vocab = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(vocab).collect()}
    assert got == plain(counts)


def test_query_on_whole_texts(spark, tmp_path):
    rng = random.Random(2)
    words = list(vocabulary(4, "abcdeÉß", 60))
    rows = [(k, " ".join(rng.choice(words).replace("b", rng.choice("bB")) + rng.choice(["", "1x", "-"]) for _ in range(200)))
            for k in range(40)] + [(77, None), (78, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counts = {}
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            h = zlib.crc32(f"{i}:{run}".encode())
            if run and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
            run = ""
    counts = {w: n for w, n in counts.items() if n > 1}
    got = queries.op13_spelling_variants(spark, str(tmp_path)).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain(counts)
    assert any(r.form for r in got)


def test_odd_rows(spark):
    docs, _ = odd_documents(spark)
    counts = spelling.word_counts(F.col("run"), spelling.letter_runs(docs, 7))
    assert {r.word for r in spelling.variants(counts).collect()} == set()
    long = "z" * 20_000
    rows = [(long, 50), (long + "y", 5), ("y" + long, 4)]
    vocab = spark.createDataFrame(rows, "word string, n bigint")
    got = {r.word: (r.root == long, r.n_near) for r in spelling.variants(vocab).collect()}
    assert got == {long: (True, 2), long + "y": (True, 1), "y" + long: (True, 1)}
    empty = spelling.word_counts(F.col("run"), spelling.letter_runs(nothing(spark), 7))
    assert spelling.variants(empty).count() == 0
