"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from weekloom.llm import collocations

from .frames import nothing, odd_documents


def plain(rows, per_lang: int, least: int) -> set:
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every piece."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inner = defaultdict(int)
    for (lang, p), a in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner[lang, p[i : i + k]] = max(inner[lang, p[i : i + k]], a)
    found = defaultdict(list)
    for (lang, p), a in cand.items():
        if 100 * inner[lang, p] >= 80 * a:
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, le, r, total[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, p, le, r) in enumerate(sorted(rows)[:per_lang], 1)
    }


def texts(seed: int):
    rng = random.Random(seed)
    words = ["the", "of", "new", "York", "city", "é", "zu", "Ünter", "x\x0by"] + [f"w{k}" for k in range(40)]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for _ in range(300):
        own = rng.choices(words, weights, k=rng.randrange(60))
        for at in range(len(own)):
            if rng.random() < 0.15:
                own[at] = rng.choice(["New York City", "of the\tnew  order", "a, b", "end.", "stop!\nthe of the of"])
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice([" ", "  ", "\t"]).join(own)))
    return rows + [("en", None), (None, ""), ("fr", " .,; ")]


def got(df) -> set:
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


@pytest.mark.parametrize(("top", "hot"), [(1 << 20, 500), (1 << 20, 12), (14, 12), (0, 500)])
def test_plain_counting(spark, monkeypatch, top, hot):
    monkeypatch.setattr(collocations, "HOT", hot)
    rows = texts(top % 97 + hot)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = plain(rows, 25, 8)
    assert len(want) > 40 and {r[0] for r in want} >= {"en", "de", "und"}
    assert got(collocations.collocations(docs, per_lang=25, least=8, top=top)) == want


def test_long_passage_and_big_counts(spark):
    line = "alpha beta gamma delta. "
    rows = [("en", line * 40_000), ("en", "beta gamma " * 50), ("en", "nospaces" * 400_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations.collocations(docs)) == plain(rows, 2000, 30)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**16
    rows = [("en", "p", 1, 3 * big + 1), ("en", "q", 1, 3 * big + 2), ("en", "p q", 2, 3 * big)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, size int, f bigint")
    (row,) = collocations.scored(counts).collect()
    assert row.score == 2000000 * 3 * big // (6 * big + 3)


def test_odd_rows(spark):
    docs, _ = odd_documents(spark)
    kept = collocations.collocations(docs, least=2).collect()
    assert kept and collocations.collocations(docs, least=2).columns == [
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.collocations(nothing(spark)).count() == 0
