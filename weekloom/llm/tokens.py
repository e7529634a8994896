"""Tokens of whole texts: byte-level BPE ids, and counts by a unigram vocabulary.

Both split a text before single spaces, where no token can cross, and keep the result of each piece in a
bounded table of the worker, because running text repeats its words. Files are parameters; they are read
by the workers and never copied.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks

#: Pieces whose result a worker keeps; a full table is emptied.
CACHE = 400_000
BPE = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
UNIGRAM = "piece_bpe_32k.model"
#: A space at which a cut would fall inside a run of white space, or a string with an id of its own.
_IRREGULAR = re.compile(r" \s| $|<\|endoftext\|>|[\x1c-\x1f\x85]")


class _Cached(dict):
    """Piece after a space -> result, computed on first use."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, piece: str):
        if len(self) >= CACHE:
            self.clear()
        value = self.compute(piece)
        if len(piece) <= 64:
            self[piece] = value
        return value


class BpeIds:
    """Ids of a text as little-endian unsigned 32-bit bytes, equal to those of the tokenizers library.

    Regular texts are cut before each space and encoded piece by piece with the same merges; a text with
    runs of white space around spaces or with a special string goes through the library whole."""

    def __init__(self, library_file: str, ranks_file: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.library = Tokenizer.from_file(library_file)
        encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.first = lambda piece: _packed(encoding.encode_ordinary(piece))
        self.after_space = _Cached(lambda piece: _packed(encoding.encode_ordinary(" " + piece)))

    def __call__(self, text: str) -> bytes:
        if _IRREGULAR.search(text):
            return _packed(self.library.encode(text, add_special_tokens=False).ids)
        head, *rest = text.split(" ")
        return self.first(head) + b"".join(map(self.after_space.__getitem__, rest))


def _packed(ids: list[int]) -> bytes:
    import array

    a = array.array("I", ids)
    return a.tobytes()


@lru_cache(maxsize=2)
def bpe(library_file: str, ranks_file: str) -> BpeIds:
    return BpeIds(library_file, ranks_file)


class UnigramCounter:
    """Best score and number of pieces of a text under a unigram vocabulary.

    Matches come from an Aho-Corasick automaton; dynamic programming keeps, per end position, the best score
    and its piece count. Tie rule of the tokenizer: candidates are taken by start position and only a
    strictly better score replaces, so the longest last piece wins. A character without a piece costs the
    least score less ten and counts as its UTF-8 bytes (byte fallback). Scores are summed as doubles.

    White space is not normalised; a space reads as the marker and one marker is put in front. If pieces have
    markers only in front or consist of them, none crosses from another character to a marker, and a text may
    be cut before every run of markers; with any other vocabulary a text is scored as one piece."""

    MARK = "▁"

    def __init__(self, pieces: list[tuple[str, float]]):
        self.unknown = min(s for _, s in pieces) - 10.0
        self.cuts = not any(self.MARK in p.lstrip(self.MARK) for p, _ in pieces)
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.after_space = _Cached(lambda piece: self.best(self.MARK + piece))
        self.runs = re.compile(f"{self.MARK}({self.MARK}*[^{self.MARK}]*)")

    def best(self, text: str) -> tuple[int, float]:
        """Piece count and score of a string without cuts."""
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(text):
            ends[end].append(found)
        score = [0.0] * (n + 1)
        count = [0] * (n + 1)
        for i in range(n):
            top, least, has_single = None, 0, False
            for size, s in sorted(ends[i], reverse=True):
                here = score[i + 1 - size] + s
                if size == 1:
                    has_single = True
                if top is None or here > top:
                    top, least = here, count[i + 1 - size] + 1
            if not has_single:
                here = score[i] + self.unknown
                if top is None or here > top:
                    top, least = here, count[i] + len(text[i].encode())
            score[i + 1], count[i + 1] = top, least
        return count[n], score[n]

    def __call__(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        plain = text.replace(self.MARK, " ")
        if self.cuts and "  " not in plain and plain[0] != " ":
            pieces = plain.split(" ")
        elif self.cuts:
            pieces = self.runs.findall(self.MARK + plain.replace(" ", self.MARK))
        else:
            return self.best(self.MARK + plain.replace(" ", self.MARK))
        counts, scores = zip(*map(self.after_space.__getitem__, pieces), strict=True)
        return sum(counts), float(sum(scores))


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    skip = [model.is_control, model.is_unknown, model.is_byte, model.is_unused]
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size()) if not any(f(i) for f in skip)
    ]


@lru_cache(maxsize=2)
def unigram(model_file: str) -> UnigramCounter:
    return UnigramCounter(vocabulary(model_file))


def texts(part: pa.RecordBatch, name: str) -> Iterator[str]:
    for t in part.column(name).to_pylist():
        yield t or ""


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, best_score`` of every whole text by the unigram vocabulary of ``model_file``.

    Null and empty texts have 0 tokens and score 0; repeated rows are counted one by one; an empty table
    gives an empty result; other columns are ignored."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        counter = unigram(model_file)
        for part, _, _ in chunks(batches, "body"):
            got = [counter(t) for t in texts(part, "body")]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "n_tokens", "best_score"],
            )

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, best_score double")
