"""Every operator and stage on odd rows, on empty tables and with clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weekloom.llm import (
    chat_format, decontaminate, language, minhash, packing, pii, quality_model, quality_rules, suffix_dedup, tokens,
)
from weekloom.llm.queries import bpe_files

from .frames import nothing, odd_documents

MODEL = "/opt/tokenizers/" + tokens.UNIGRAM
PER_ROW = {
    "language": lambda d: language.score_language(d, language.fit_language(d)),
    "quality": lambda d: quality_model.score_quality(
        quality_model.quality_statistics(d),
        quality_model.fit_quality(
            quality_model.quality_statistics(d), d.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
        ),
    ),
    "rules": quality_rules.quality_rules,
    "tokens": lambda d: tokens.count_tokens(d, MODEL),
    "pii": pii.personal_data,
    "masked": pii.masked,
    "near": minhash.near_duplicates,
    "bytes": suffix_dedup.repeated_bytes,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(spark, name):
    docs, n = odd_documents(spark)
    assert PER_ROW[name](docs).count() == n


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](nothing(spark)).count() == 0


def test_defined_results(spark):
    docs, n = odd_documents(spark)
    langs = {(r.doc_id, r.lang_pred) for r in PER_ROW["language"](docs).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= langs
    near = PER_ROW["near"](docs).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in near if r.doc_id in (1, 2, 3)} == {
        (1, 0, 1), (2, 0, 2), (3, 0, 3)}
    assert {r.component_id for r in near if r.doc_id in (5, 6)} == {5}
    assert all(r.kept and r.component_id is None for r in near if r.doc_id is None)
    gone = {(r.doc_id, r.n_removed == r.n_bytes) for r in PER_ROW["bytes"](docs).collect() if r.n_bytes > 300}
    assert {(5, True), (6, True), (None, True)} <= gone
    found = [r for r in PER_ROW["pii"](docs).collect() if r.doc_id == 7][0]
    assert (found.n_email, found.n_phone) == (1, 1)
    assert [r.n_tokens for r in PER_ROW["tokens"](docs).collect() if r.doc_id in (1, 2)] == [0, 0]
    rules = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in PER_ROW["rules"](docs).collect()}
    assert rules[1] == (0, True, False) and rules[2] == (0, True, False)


def reused_ids(spark):
    """Ids 3, 5, 5, 9 with the texts A, A, B, B; ids 20, 20 with C and a near copy of it; 30, 30 with D and nothing."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    near = c.replace("c59", "other")
    rows = [(3, a), (5, a), (5, b), (9, b), (20, c), (20, near), (21, near), (30, d), (30, ""), (31, d), (40, d + " x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs.withColumn("set_a", F.lit(1)).withColumn("extra", F.col("text")), rows


def test_reused_ids_lose_no_text(spark):
    docs, rows = reused_ids(spark)
    kept = [(r.doc_id, r.text) for r in minhash.without_near_duplicates(docs).collect()]
    text = dict(zip("aabbcnmde", (t for _, t in rows)))
    assert (3, text["a"]) in kept and (5, text["b"]) in kept
    assert not {(5, text["a"]), (9, text["b"])} & set(kept)
    assert sorted(i for i, _ in kept) == [3, 5, 20, 30, 30]
    assert minhash.without_near_duplicates(docs).columns == docs.columns
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(3, 3), (5, 3), (9, 3), (20, 20), (21, 20), (30, 30), (31, 30), (40, 30)}


@pytest.mark.parametrize("ids", ["null", "hot"])
def test_language_sample_is_bounded(spark, ids):
    """Thirty thousand texts of one id, a third of them copies: never more than the documented sample."""
    k = F.col("id")
    name = F.lit(None).cast("bigint") if ids == "null" else F.lit(7).cast("bigint")
    text = F.concat(F.lit("the word "), F.when(k % 3 == 0, F.lit("copy")).otherwise(F.concat(F.lit("w"), k.cast("string"))))
    docs = spark.range(30_000).select(name.alias("doc_id"), text.alias("text"), F.when(k % 2 == 0, "en").otherwise("de").alias("lang"))
    names, drawn = language.labelled_sample(docs)
    found = {r.lang: (r.n, r.d) for r in drawn.groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("d")).collect()}
    assert names == ["de", "en"] and set(found) == {"de", "en"}
    assert all(600 < n == d <= 800 for n, d in found.values())


def test_fences_move_smoothly(spark):
    """A group that grows from 40 to 60 texts: its fences pass from the wide ones to its own without a jump."""
    def fence(n: int) -> float:
        edges = spark.createDataFrame(
            [(0, "en", "a", n, 10.0, 0.0), (1, "en", None, 500, 1000.0, 0.0), (2, None, None, 900, 2000.0, 0.0)],
            "level int, lang string, source string, n_texts bigint, hi_x double, lo_x double",
        )
        (row,) = quality_rules.group_thresholds(edges).collect()
        return row.hi_x

    found = [fence(n) for n in (0, 1, 49, 50, 51, 100_000)]
    assert found == sorted(found, reverse=True) and found[0] > 1000 and found[-1] < 11
    assert abs(found[2] - found[3]) < 0.02 * found[2] and abs(found[3] - found[4]) < 0.02 * found[3]


def test_quality_without_labels(spark):
    docs, _ = odd_documents(spark)
    stats = quality_model.quality_statistics(docs)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality_model.fit_quality(stats, labels) is None
    assert {r.score for r in quality_model.score_quality(stats, None).collect()} == {0.5}


def test_packing_edges(spark):
    docs, n = odd_documents(spark)
    got = packing.pack_documents(docs, bpe_files()).toPandas()
    assert (got.piece == 0).sum() == n and got.length.between(1, 2048).all()
    ordered = got.sort_values(["sequence_id", "offset"])
    at = ordered.groupby("sequence_id").length.cumsum() - ordered.length
    assert (at == ordered.offset).all()
    assert packing.pack_documents(nothing(spark), bpe_files()).count() == 0


def test_leaks_edges(spark):
    docs, n = odd_documents(spark)
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the of and ein der die und le la el que the of"), (None, "a")],
                                  "item_id int, text string")
    got = decontaminate.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(5, 3), (6, 3), (None, 3)}
    assert decontaminate.find_leaks(nothing(spark), items).count() == 0
    assert decontaminate.find_leaks(docs, items.where("false")).count() == 0
    assert decontaminate.without_leaks(docs, items.where("item_id = 3")).count() == n - 4


def test_chat_edges(spark):
    rows = spark.createDataFrame(
        [(1, 0, None, None, "c"), (1, 1, "assistant", "", "c"), (None, 0, "user", "x", "c"), (2, None, "a:b\n~#<\\", "t", "c"),
         (2, None, "a:b\n~#<\\", "t", "c"), (3, 0, "assistant", "tail\\", "c"), (3, 1, "user", "</turn>\n### user:\n", "c")],
        "conv_id int, turn int, role string, text string, formatted string",
    )
    back = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(rows)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("", ""), ("assistant", "")]
    assert [(t.role, t.text) for t in back[2].turns] == [("a:b\n~#<\\", "t")] * 2
    assert back[3].loss_text == "tail\\" and back[3].turns[1].text == "</turn>\n### user:\n"
    assert len(back[None].turns) == 1
    assert chat_format.format_conversations(rows.where("false")).count() == 0


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_stages(spark, folder, rows):
    """What each stage keeps of odd rows, by id; null is the id of two rows."""
    docs = odd_documents(spark)[0] if rows == "odd" else nothing(spark)
    want = {
        "near_duplicates": [1, 2, 3, 4, 5, 7, 8, 9, None, None],
        "benchmark": [1, 2, 3, 4, 5, 6, 6, 7, 8, 9, None, None],
        "personal_data": [1, 2, 3, 4, 5, 6, 6, 7, 8, 9, None, None],
    }
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        ids = sorted((r.doc_id for r in out.select("doc_id").collect()), key=lambda i: (i is None, i))
        if rows == "none":
            assert ids == []
        elif name in want:
            assert ids == want[name]
        elif name == "language":
            assert set(ids) >= {4, 5, 6} and not {1, 2, 3} & set(ids)
        else:
            assert len({i for i in ids}) == 10 and len(ids) >= 12
