"""Small frames for the operators: odd rows, and brute-force versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LONG = "word%d and more " 
DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
#: Columns that clash with names the operators use inside.
CLASH = ("score", "body", "x", "n", "rep", "key", "kept", "name", "anchor", "rank", "salt", "t", "words", "label", "i")


def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a long text, ties and repeated rows."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(9000))
    prose = "the of and ein der die und le la el que " * 8
    rows = [
        (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 3), (4, long, "en", "a", len(long)),
        (5, prose, "de", "a", 1), (6, prose, "de", "a", 1), (6, prose, "de", "a", 1), (None, prose, "fr", "b", 1),
        (None, None, None, None, None), (7, "é\x00ü mail a.b@c.de +49 171 1234567 ok", "fr", "b", None),
        (8, "12345 67890 ### </turn> ||| $$$", "en", "b", 9), (9, "a", "en", "b", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASH:
        df = df.withColumn(c, df["lang"])
    return df, len(rows)


def nothing(spark):
    df = spark.createDataFrame([], DOCS)
    for c in CLASH:
        df = df.withColumn(c, df["lang"])
    return df


def shingles(text: str) -> frozenset:
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def near_components(rows) -> dict:
    """Least reachable id per id, from all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for h in sets[i] for j in holders[h])
        for j, c in common.items():
            if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for h in sets[i]:
            holders[h].append(i)
    return {i: find(i) for i in sets}


def repeated(rows, length: int = 200) -> list[tuple]:
    """(id, bytes, removed, spans, digest of the rest) by counting every window."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
