"""Similarity join on 3-word shingles against all pairs."""

import random

import numpy as np
import pytest

from weekloom.llm import jaccard_join

from .frames import nothing, odd_documents


def shingles(text: str) -> frozenset:
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def all_pairs(rows) -> dict:
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, z in sets[:k]:
            common = len(s & z)
            if common and 100 * common >= 90 * (len(s) + len(z) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets}


def planted(seed: int):
    """Groups of near copies of every grade, a passage in a third of all texts, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for length, copies in ((9, 20), (12, 30), (40, 40), (150, 120), (152, 20), (700, 30)):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(1 + length // 25)):
                own[rng.randrange(length)] = f"x{rng.randrange(5000)}"
            rows.append(own + [rng.choice(vocabulary)] * rng.randrange(2))
    for _ in range(150):
        rows.append(passage + [rng.choice(vocabulary) for _ in range(rng.randrange(4))])
    rows += [[rng.choice(vocabulary) for _ in range(rng.randrange(12))] for _ in range(150)]
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("block", [4, 256])
def test_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = planted(block)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_texts(docs).collect()}
    assert got == all_pairs(rows)
    assert len({c for _, c in got.values()}) < len(rows) - 150


def test_bands_hold_all_partners():
    edges = jaccard_join.bands(5000)
    band = np.searchsorted(edges, np.arange(5001), side="right") - 1
    for n in range(jaccard_join.LEAST, 4000):
        assert band[10 * n // 9] - band[n] <= 1


def test_bits_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    text = [" ".join(f"a{x}" for x in rng.integers(0, 500, size)) for size in (3, 40, 44, 130, 700, 720)]
    raw = [t.encode() for t in text]
    data = np.frombuffer(b"".join(raw), np.uint8)
    s = jaccard_join.Shingles(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    bits = [np.array(b, np.int64).view(np.uint64) for b in s.bitmaps().to_pylist()]
    for i in range(len(text)):
        for j in range(len(text)):
            x, y = bits[i], bits[j]
            while len(x) > len(y):
                x = jaccard_join._halved(x[None])[0]
            while len(y) > len(x):
                y = jaccard_join._halved(y[None])[0]
            assert np.bitwise_count(x ^ y).sum() <= len(shingles(text[i]) ^ shingles(text[j]))


def test_odd_rows(spark):
    docs, n = odd_documents(spark)
    got = jaccard_join.similar_texts(docs).collect()
    assert len(got) == n
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert by_id[1] == by_id[2][:1] + (1,) and by_id[3] == (0, 3) and by_id[9] == (1, 9)
    assert by_id[5][1] == by_id[6][1] == 5
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert jaccard_join.similar_texts(nothing(spark)).count() == 0


def test_reused_ids_share_a_component(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    docs = spark.createDataFrame([(3, one), (5, one), (5, two), (9, two), (11, "")], "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id) for r in jaccard_join.similar_texts(docs).collect()}
    assert got == {(3, 3), (5, 3), (9, 3), (11, 11)}


def test_very_long_texts(spark):
    rng = random.Random(5)
    words = [f"v{rng.randrange(30000)}" for _ in range(400_000)]
    other = words[:200_000] + ["changed"] + words[200_001:]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(other)), (3, "x" * 3_000_000)], "doc_id bigint, text string"
    )
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_texts(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
