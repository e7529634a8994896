"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers with a plus sign. The
random field adds what has the shape and the surroundings of personal data but not the pattern: local phone
numbers, keys, passwords and tokens. Its spans are added where no pattern matched; cards and addresses it
finds must also pass the checksum and range tests.

A word without digit or ``@`` is never part of personal data, so only runs of other words are sequences; the
words around them are features. The field is trained on a small labelled table (``training_rows``: sentences
with marked spans, filled in by rule) and decoded by Viterbi over batches of runs of equal length.

Defined results: a null text is empty; texts without personal data have empty spans; repeated rows are
searched one by one; an empty table gives an empty result; other columns are ignored. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, sums

#: Bytes of text a task works on at once.
CHUNK = 1 << 19
#: Kinds in the order of output: those of the patterns, then the one that only the random field knows.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = re.compile("[0-9@]")
_SIGNS = np.zeros(256, np.int64)
_SIGNS[48:58] = 1
_SIGNS[ord("@")] = 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 16 <= len(d) <= 19 and luhn(d)


def emails(text: str) -> list[Span]:
    """Matches by their ``@``: the longest run before it that no earlier match holds, then the domain."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def addresses(text: str) -> list[Span]:
    """Every four parts of a dotted chain of numbers."""
    out = []
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in four):
                out.append(("ip", at, at + size))
            at += size + 1
    return out


def base_spans(text: str) -> list[Span]:
    """Pattern matches, by kind and start."""
    found = emails(text) + addresses(text)
    found += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# --- random field ---------------------------------------------------------------------------------------

TAGS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
FEATURES = 1 << 13


def _allowed() -> np.ndarray:
    """Transitions between tags: an I tag follows the B or I tag of its kind only."""
    ok = np.ones((len(TAGS), len(TAGS)), bool)
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            ok[:, j] = [s[2:] == t[2:] for s in TAGS]
    return ok


_OK = _allowed()
_STARTS = np.array([t[0] != "I" for t in TAGS])


def shape(word: str) -> str:
    """The word with runs of digits, capitals and small letters as one sign each, other signs as they are."""
    s = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word))
    return re.sub(r"(.)\1+", r"\1", s)[:24]


def _word_features(word: str) -> list[str]:
    core = word.strip(".,;:!?\"'*#$%&|<>")
    n = len(_digits(core))
    letters = sum(c.isalpha() for c in core)
    size = min(len(core), 40) if len(core) < 16 else len(core) // 8 * 8
    return [
        f"shape {shape(core)}", f"digits {n if n < 13 else n // 4 * 4}", f"size {size}",
        f"letters {min(letters, 3)}", f"head {core[:1] if not core[:1].isalnum() else ''}",
        f"hex {bool(re.fullmatch(r'[0-9a-f]{12,}', core))}", f"key {bool(re.fullmatch(r'[A-Z0-9]{16,}', core))}",
        f"digits,letters {min(n, 9)},{min(letters, 2)}", f"equals {'=' in core}", f"at {'@' in core}",
    ]


def _near(word: str | None) -> str:
    if word is None:
        return "none"
    plain = re.sub(r"[^a-z]", "", word.lower())
    return f"word {plain}" if plain and len(plain) == len(word.strip(".,:;")) else f"shape {shape(word)}"


@dataclass(frozen=True)
class Run:
    """A run of words with digits or ``@``: where they are, and the features of each."""

    starts: list[int]
    ends: list[int]
    features: list[list[int]]


def runs(text: str) -> list[Run]:
    """Runs of such words in order, with their neighbours, however far away, as features."""
    out: list[Run] = []
    before = before2 = waiting = None
    end = 0
    for m in chain(_WORD.finditer(text), [None]):
        word = m and m[0]
        follows = waiting is not None
        if follows:
            names = [*waiting, f"after {_near(word)}", "any"]
            out[-1].features.append([crc32(x.encode()) % FEATURES for x in names])
            waiting = None
        if m and _SIGN.search(word):
            if not follows or m.start() - end > 2:
                out.append(Run([], [], []))
            out[-1].starts.append(m.start())
            out[-1].ends.append(m.end())
            waiting = [*_word_features(word), f"before {_near(before)}", f"before two {_near(before2)}"]
            end = m.end()
        before, before2 = word, before
    return out


@dataclass(frozen=True)
class Field:
    """Weights: features by tags, and transitions between tags."""

    emission: np.ndarray
    transition: np.ndarray


def viterbi(scores: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Best tags of a batch of sequences of one length: ``scores`` is batch, place, tag."""
    batch, n, _ = scores.shape
    step = np.where(_OK, transition, -1e9)
    best = scores[:, 0] + np.where(_STARTS, 0, -1e9)
    back = np.zeros((batch, n, len(TAGS)), np.int64)
    for i in range(1, n):
        total = best[:, :, None] + step
        back[:, i] = total.argmax(axis=1)
        best = total.max(axis=1) + scores[:, i]
    tags = np.zeros((batch, n), np.int64)
    tags[:, -1] = best.argmax(axis=1)
    for i in range(n - 1, 0, -1):
        tags[:, i - 1] = back[np.arange(batch), i, tags[:, i]]
    return tags


def decode(all_runs: list[Run], field: Field) -> list[np.ndarray]:
    """Tags of every run, in batches of equal length."""
    tags: list[np.ndarray] = [np.zeros(0, np.int64)] * len(all_runs)
    by_length: dict[int, list[int]] = {}
    for i, r in enumerate(all_runs):
        by_length.setdefault(len(r.starts), []).append(i)
    for n, members in by_length.items():
        step = max(1, 200_000 // n)
        for k in range(0, len(members), step):
            part = members[k : k + step]
            index = np.array([all_runs[i].features for i in part])
            for i, t in zip(part, viterbi(field.emission[index].sum(axis=2), field.transition), strict=True):
                tags[i] = t
    return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def train(sequences: list[tuple[list[list[int]], list[int]]], epochs: int = 25, rate: float = 0.3,
          penalty: float = 2e-3) -> Field:
    """Field with the greatest penalised likelihood, by adaptive gradient steps over the sequences."""
    k = len(TAGS)
    emission, transition = np.zeros((FEATURES, k)), np.zeros((k, k))
    e_sum, t_sum = np.full((FEATURES, k), 1e-8), np.full((k, k), 1e-8)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for s in rng.permutation(len(sequences)):
            features, tags = sequences[s]
            index = np.array(features)
            scores = emission[index].sum(axis=1)
            step = np.where(_OK, transition, -1e9)
            n = len(tags)
            ahead, behind = np.empty((n, k)), np.zeros((n, k))
            ahead[0] = scores[0] + np.where(_STARTS, 0, -1e9)
            for i in range(1, n):
                ahead[i] = _log_sum(ahead[i - 1][:, None] + step, 0) + scores[i]
            for i in range(n - 2, -1, -1):
                behind[i] = _log_sum(step + (scores[i + 1] + behind[i + 1])[None, :], 1)
            z = _log_sum(ahead[-1], 0)
            gradient = np.exp(ahead + behind - z)
            gradient[np.arange(n), tags] -= 1
            g = penalty * transition
            for i in range(1, n):
                g = g + np.exp(ahead[i - 1][:, None] + step + (scores[i] + behind[i])[None, :] - z)
                g[tags[i - 1], tags[i]] -= 1
            t_sum += g * g
            transition = transition - rate * g / np.sqrt(t_sum)
            for i in range(n):
                g = gradient[i] + penalty * emission[index[i]]
                e_sum[index[i]] += g * g
                emission[index[i]] -= rate * g / np.sqrt(e_sum[index[i]])
    return Field(emission, transition)


#: Sentences of the labelled table. Names in braces are filled in by rule; those of ``KINDS`` are labelled.
SENTENCES = (
    "please call {local} after noon", "my number is {local} thanks", "tel. {local}, ask for Ana",
    "call {phone} or {local} today", "Phone: {phone}.", "ring the office at {phone} please",
    "write to {email} soon", "contact {email}, or {email}", "the mail of Tom is {email}.",
    "the host {ip} did not answer", "from {ip} to {ip} in one hop", "paid with {card} in May",
    "card no. {card} was refused", "the key {key} was revoked", "use {key} and {key} for access",
    "login with password={hex} now", "set password={hex} in the file", "the token = \"{long}\" expired",
    "token = \"{long}\" and more", "api key: {long} is secret",
    "there are {small} words in chapter {small}", "licensed under version {version} of it", "in {year} we had {small} of them",
    "the order {nine} has arrived", "it was {nine} that day", "see page {small}, line {small}", "on {date} at {time} we met",
    "about {small}% of {big} people", "section {version} and {version}.", "row {nine} of table {small}", "{big} and {nine} are numbers",
    "{nine}", "{version}", "{year}", "room {small} on floor {small}", "it costs {big} or less",
)


def training_rows(copies: int = 12, seed: int = 3) -> list[tuple[str, list[Span]]]:
    """The labelled table: texts with spans, every sentence filled in ``copies`` times."""
    rng = np.random.default_rng(seed)

    def number(n: int) -> str:
        return "".join(str(d) for d in rng.integers(0, 10, n))

    def word(n: int) -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))

    def pick(*options: str) -> str:
        return str(rng.choice(options))

    def card() -> str:
        d = number(15)
        d += next(c for c in "0123456789" if luhn(d + c))
        return pick(" ", "-", "").join(d[i : i + 4] for i in range(0, 16, 4))

    fill = {
        "local": ("phone", lambda: pick(f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}",
                                        f"0{number(2)} {number(3)} {number(4)}")),
        "phone": ("phone", lambda: pick(f"+1 ({number(3)}) 555-{number(4)}", f"+49 {number(3)} {number(7)}", f"+33-{number(9)}")),
        "email": ("email", lambda: f"{word(5)}{pick('.', '_', '')}{word(4)}{pick('', number(2))}@{word(6)}.{pick('com', 'org', 'de')}"),
        "ip": ("ip", lambda: ".".join(str(x) for x in rng.integers(1, 255, 4))),
        "card": ("card", card),
        "key": ("secret", lambda: "AKIA" + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 16)) + pick("", "7")),
        "hex": ("secret", lambda: "".join(rng.choice(list("0123456789abcdef"), 18))),
        "long": ("secret", lambda: "".join(rng.choice(list("0123456789abcdef"), 40))),
        "small": (None, lambda: number(int(rng.integers(1, 3)))), "nine": (None, lambda: number(int(rng.integers(5, 13)))),
        "version": (None, lambda: f"{number(1)}.{number(1)}"), "year": (None, lambda: f"20{number(2)}"),
        "date": (None, lambda: f"20{number(2)}-0{number(1)}-1{number(1)}"), "time": (None, lambda: f"1{number(1)}:3{number(1)}"),
        "big": (None, lambda: f"{number(1)},{number(3)}"),
    }
    rows = []
    for _ in range(copies):
        for sentence in SENTENCES:
            text, spans = "", []
            for part in re.split(r"(\{\w+\})", sentence):
                if part[:1] == "{":
                    kind, make = fill[part[1:-1]]
                    value = make()
                    if kind:
                        spans.append((kind, len(text), len(text) + len(value)))
                    part = value
                text += part
            rows.append((text, spans))
    return rows


def fit_field(rows: list[tuple[str, list[Span]]]) -> Field:
    """Train on texts with spans; a word is tagged by the span it overlaps."""
    sequences = []
    for text, spans in rows:
        for r in runs(text):
            tags, before = [], None
            for a, b in zip(r.starts, r.ends, strict=True):
                over = next((s for s in spans if s[1] < b and a < s[2]), None)
                tags.append(0 if over is None else TAGS.index(f"{'I' if over is before else 'B'}-{over[0]}"))
                before = over
            sequences.append((r.features, tags))
    return train(sequences)


def field_spans(text: str, run: Run, tags: np.ndarray) -> list[Span]:
    """Spans of a tagged run, without the signs around them, as far as they pass the kind's own test."""
    out = []
    i = 0
    while i < len(tags):
        tag = TAGS[tags[i]]
        if tag[0] != "B":
            i += 1
            continue
        j = i + 1
        while j < len(tags) and TAGS[tags[j]] == "I" + tag[1:]:
            j += 1
        start, end, kind = run.starts[i], run.ends[j - 1], tag[2:]
        if kind == "secret" and "=" in text[start:end]:
            start = text.index("=", start, end) + 1
        while start < end and not (text[start].isalnum() or kind == "phone" and text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        value = text[start:end]
        n = len(_digits(value))
        good = {
            "email": bool(re.search(r"[^@]@[^@]+\.", value)), "ip": bool(addresses(value)), "card": _is_card(value),
            "phone": 8 <= n <= 15 and not any(c.isalpha() for c in value), "secret": len(value) >= 12 and n > 0,
        }[kind]
        if good:
            out.append((kind, start, end))
        i = j
    return out


def find_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Per text the pattern spans and all spans, each by kind and start."""
    base = [base_spans(t) for t in texts]
    found = [runs(t) for t in texts]
    tags = iter(decode([r for own in found for r in own], field))
    out = []
    for text, own, listed in zip(texts, base, found, strict=True):
        every = list(own)
        for r in listed:
            for s in field_spans(text, r, next(tags)):
                if not any(s[1] < b and a < s[2] for _, a, b in own):
                    every.append(s)
        out.append((own, sorted(every, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _searched(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, name: str, field: Field):
    """Rows of a chunk that have a digit or ``@``, and what is found in them."""
    rows = np.flatnonzero(sums(_SIGNS[data], offsets))
    texts = part.column(name).take(pa.array(rows)).to_pylist()
    return rows, texts, find_spans(texts, field)


def personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, a count per pattern kind, ``base_spans`` and ``spans`` (kind:start:end, comma-joined)."""
    field = field or fit_field(training_rows())
    kind = docs.schema[id_col].dataType.simpleString()
    counts = [f"n_{k}" for k in BASE_KINDS]

    def run(batches):
        for part, data, offsets in chunks(batches, "body", CHUNK):
            n = np.zeros((len(BASE_KINDS), part.num_rows), np.int64)
            base, every = [""] * part.num_rows, [""] * part.num_rows
            rows, _, found = _searched(part, data, offsets, "body", field)
            for i, (own, spans) in zip(rows.tolist(), found, strict=True):
                for s in own:
                    n[BASE_KINDS.index(s[0]), i] += 1
                base[i], every[i] = joined(own), joined(spans)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, n), pa.array(base), pa.array(every)],
                names=["doc_id", *counts, "base_spans", "spans"],
            )

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    schema = ", ".join([f"doc_id {kind}", *[f"{c} bigint" for c in counts], "base_spans string, spans string"])
    return narrow.mapInArrow(run, schema)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first, then the longest, counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        elif b > at:
            at = b
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with personal data in the text replaced by ``[KIND]``; other columns are unchanged."""
    field = field or fit_field(training_rows())
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches):
        for part, data, offsets in chunks(batches, text_col, CHUNK):
            rows, texts, found = _searched(part, data, offsets, text_col, field)
            changed = {i: mask(t, spans) for i, t, (_, spans) in zip(rows.tolist(), texts, found, strict=True) if spans}
            if changed:
                values = part.column(at).to_pylist()
                for i, t in changed.items():
                    values[i] = t
                arrays = list(part.columns)
                arrays[at] = pa.array(values, part.column(at).type)
                part = pa.RecordBatch.from_arrays(arrays, schema=part.schema)
            yield part

    return docs.mapInArrow(run, docs.schema)

