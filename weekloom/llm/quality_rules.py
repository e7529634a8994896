"""Quality rules with thresholds learned per language and source.

Fixed base rules (under 50 words; more than half of the words in repeated 3-word windows) come first.
The rest of the verdict has no fixed cutoffs: ratios of each text are kept as integers in parts per
million, their distribution per (language, source) is held in a mergeable quantile sketch, and a text
fails if a ratio lies outside the fences of its own group.

The sketch is a histogram with geometric buckets (a value keeps its seven leading binary digits, so a
quantile is exact to 1/64 of itself). It merges by adding counts, in any order, with the same result:
thresholds do not depend on partitioning or retries. The fences of a group are drawn towards those of its
language, and these towards the overall ones, the more so the fewer texts it has; both come from sums of the group
sketches.

Everything is DataFrame expressions. Defined results: null text counts as empty; null language or source
is a group of its own; repeated rows are judged one by one; an empty table gives an empty result; columns
besides the four named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

SPACE = r"[\x20\x09-\x0D]+"
MILLION = 1_000_000
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
#: Ratios that are bounded above by a fence, and those bounded on both sides.
UPPER = ("symbol_ppm", "dup_line_ppm", "repeat_ppm")
BOTH = ("word_len_ppm",)
#: A fence is this many spreads (75 % quantile less 25 % quantile) beyond the quartile.
SPREADS = 3
#: Smallest spread, in parts per million: a group without any variation still accepts small deviations
#: (a hundredth of the characters, a tenth of the lines and of the words, half a character per word).
LEAST_SPREAD = {"symbol_ppm": 10_000, "dup_line_ppm": 100_000, "repeat_ppm": 100_000, "word_len_ppm": 500_000}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _repeated_windows(windows: Column, ordered: Column) -> Column:
    """Start positions, ascending, of the windows that occur at least twice. ``ordered``: the sorted windows."""
    twice = F.array_distinct(
        F.filter(ordered, lambda x, i: (i > 0) & (x == F.get(ordered, i - F.lit(1))))
    )

    def by_lookup(keys):
        return F.filter(
            F.transform(windows, lambda h, i: F.when(F.array_contains(keys, h), i)),
            lambda p: p.isNotNull(),
        )

    def by_sort():
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(
            placed,
            lambda q: F.array_sort(
                F.transform(
                    F.filter(
                        q,
                        lambda x, i: F.coalesce(F.get(q, i - F.lit(1))["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(q, i + F.lit(1))["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    none = F.array().cast("array<int>")
    return _let(
        twice,
        lambda keys: F.when(F.size(keys) == 0, none)
        .when(F.size(keys) <= 64, by_lookup(keys))
        .otherwise(by_sort()),
    )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts per text: ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split("t", SPACE), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(
        F.size("words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(
                F.get("words", i), F.get("words", i + F.lit(1)), F.get("words", i + F.lit(2))
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
    )["n"]
    counted = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), text.alias("t"),
    ).select("doc_id", "lang", "source", "t", words.alias("words"), lines.alias("lines"))
    counted = counted.select(
        "doc_id", "lang", "source",
        F.size("words").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        windows.alias("windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    return (
        counted.select("*", F.sort_array("windows").alias("ordered"))
        .select("doc_id", "lang", "source", *counts,
                _repeated_windows(F.col("windows"), F.col("ordered")).alias("starts"))
        .select("doc_id", "lang", "source", *[F.col(c).cast("bigint").alias(c) for c in counts],
                covered.cast("bigint").alias("n_repeat_words"))
    )


def _ppm(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"{part} * {MILLION} div {whole}")).otherwise(F.lit(0).cast("bigint"))


def with_verdict_inputs(stats: DataFrame) -> DataFrame:
    """Add ``base_failed`` and the ratios the fences are for."""
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")
    )
    return stats.select(
        "*", base.alias("base_failed"),
        _ppm("n_symbols", "word_chars").alias("symbol_ppm"),
        _ppm("n_dup_lines", "n_lines").alias("dup_line_ppm"),
        _ppm("n_repeat_words", "n_words").alias("repeat_ppm"),
        _ppm("word_chars", "n_words").alias("word_len_ppm"),
    )


def bucket(value: Column) -> Column:
    """Lower bound of the sketch bucket of a non-negative integer."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("bigint")
    return value - F.pmod(value, step)


def group_sketches(rows: DataFrame) -> DataFrame:
    """Counts per (lang, source, ratio, bucket), with rolled-up sketches per language and over all.

    ``level`` 0: language and source, 1: language, 2: all."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("ratio"), bucket(F.col(m)).alias("bucket")) for m in UPPER + BOTH])
    )
    fine = (
        rows.select("lang", "source", pairs.alias("x"))
        .groupBy("lang", "source", "x.ratio", "x.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    none = F.lit(None).cast("string")

    def group(level: int, lang: Column, source: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))

    levels = F.explode(
        F.array(
            group(0, F.col("lang"), F.col("source")), group(1, F.col("lang"), none), group(2, none, none)
        )
    )
    return (
        fine.select(levels.alias("g"), "ratio", "bucket", "n")
        .groupBy("g.level", "g.lang", "g.source", "ratio", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fences(sketches: DataFrame) -> DataFrame:
    """One row per level and group: its number of texts and ``lo_``/``hi_`` fences of each ratio.

    A quantile is the first bucket at which the counts so far reach the share."""
    group = ["level", "lang", "source", "ratio"]
    along = Window.partitionBy(*group).orderBy("bucket")
    run = sketches.select(
        *group, "bucket", F.sum("n").over(along).alias("upto"),
        F.sum("n").over(Window.partitionBy(*group)).alias("total"),
    )

    def quantile(pct: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= pct * F.col("total"), F.col("bucket")))

    quart = run.groupBy(*group).agg(
        F.max("total").alias("total"), quantile(25).alias("q1"), quantile(75).alias("q3")
    )
    least = F.lit(0)
    for m, width in LEAST_SPREAD.items():
        least = F.when(F.col("ratio") == m, F.lit(width)).otherwise(least)
    spread = SPREADS * F.greatest(F.col("q3") - F.col("q1"), least)
    edges = []
    for m in UPPER + BOTH:
        edges.append(F.max(F.when(F.col("ratio") == m, F.col("q3") + spread)).alias(f"hi_{m}"))
        if m in BOTH:
            edges.append(F.max(F.when(F.col("ratio") == m, F.col("q1") - spread)).alias(f"lo_{m}"))
    return quart.groupBy("level", "lang", "source").agg(F.max("total").alias("n_texts"), *edges)


def group_thresholds(edges: DataFrame, prior: int = 50) -> DataFrame:
    """Fences per (lang, source), drawn towards those of the language, and these towards the overall ones.

    A group's own fences weigh as much as it has texts, the wider ones as much as ``prior`` texts. One text more or
    less moves a fence a little; no number of texts switches a group to other fences."""
    names = [c for c in edges.columns if c[:3] in ("hi_", "lo_")]
    packed = edges.select("level", "lang", "source", F.col("n_texts").cast("double").alias("n"), F.struct(*names).alias("f"))
    own = packed.where("level = 0").select("lang", "source", "n", "f")
    by_lang = packed.where("level = 1").select(
        F.col("lang").alias("l_lang"), F.col("n").alias("l_n"), F.col("f").alias("l_f")
    )
    overall = packed.where("level = 2").select(F.col("f")).scalar()
    weight = F.lit(float(prior))
    both = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang"))).withColumn("a_f", overall)

    def drawn(c: str) -> Column:
        wide = (F.col("l_n") * F.col(f"l_f.{c}") + weight * F.col(f"a_f.{c}")) / (F.col("l_n") + weight)
        return ((F.col("n") * F.col(f"f.{c}") + weight * wide) / (F.col("n") + weight)).alias(c)

    return both.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *map(drawn, names))


def quality_rules(docs: DataFrame, prior: int = 50) -> DataFrame:
    """Statistics, ``base_failed``, one flag per ratio outside its group's fences, and ``kept``.

    The statistics are stored once: the sketches and the filter both read them, the texts are read once.
    Sketches are taken over the texts that pass the base rules; a group without any has no fences, and its
    texts fail by the base rules alone."""
    rows = stored(with_verdict_inputs(text_statistics(docs)), "quality-rules")
    limits = stored(
        group_thresholds(fences(group_sketches(rows.where("not base_failed"))), prior), "quality-fences"
    )
    outside = {m: F.coalesce(F.col(m) > F.col(f"hi_{m}"), F.lit(False)) for m in UPPER}
    outside |= {
        m: F.coalesce((F.col(m) > F.col(f"hi_{m}")) | (F.col(m) < F.col(f"lo_{m}")), F.lit(False))
        for m in BOTH
    }
    any_outside = F.lit(False)
    for c in outside.values():
        any_outside = any_outside | c
    return rows.join(
        limits,
        F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")),
        "left",
    ).select(
        *rows.columns, *[c.alias(f"outside_{m}") for m, c in outside.items()],
        (~F.col("base_failed") & ~any_outside).alias("kept"),
    )
