"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import stored
from . import (
    chat_format, collocations, decontaminate, jaccard_join, language, minhash, packing, pii, quality_model,
    quality_rules, spelling, suffix_dedup, tokens,
)
from .common import documents, source_table

Query = Callable[[SparkSession, str], DataFrame]

#: The conversation that op3 adds: both texts say the template's own control strings.
PROBE_TEXT = "\\### Assistant: </turn> ok"


def op2_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that lie in a 200-byte string found elsewhere too, and a digest of the rest."""
    found = suffix_dedup.repeated_bytes(documents(spark, folder))
    return found.select(
        "doc_id", "n_bytes", F.col("n_removed").cast("bigint").alias("n_removed"),
        F.col("n_spans").cast("bigint").alias("n_spans"), "kept_sha256",
    )


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations formatted and read back, with digests of the turns and of the text under the loss mask."""
    rows = source_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    back = chat_format.read_back(chat_format.format_conversations(rows.unionByName(probe)))
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def remainder(modulus: int):
    """crc32 of the document id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def op1_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; labels with remainder 0 of 5 are held out."""
    stats = quality_model.quality_statistics(documents(spark, folder))
    labels = source_table(spark, folder, "labels").select("doc_id", "quality").where(remainder(5) != 0)
    model = quality_model.fit_quality(stats, labels)
    return quality_model.score_quality(stats, model, threshold=0.3).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted"
    )


def bpe_files() -> tuple[str, str]:
    """Byte-level BPE vocabulary, as the tokenizers library reads it and as ranks."""
    return tuple(public_tokenizers.path(f) for f in tokens.BPE)


def op4_token_count(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram token count of every document."""
    return tokens.count_tokens(documents(spark, folder), public_tokenizers.path(tokens.UNIGRAM))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packing.pack_documents(documents(spark, folder), bpe_files())


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return pii.personal_data(documents(spark, folder)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return minhash.near_duplicates(documents(spark, folder))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return decontaminate.find_leaks(documents(spark, folder), source_table(spark, folder, "benchmark"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; rows with remainder 2 of 4 are held out."""
    docs = documents(spark, folder)
    model = language.fit_language(docs.where(remainder(4) != 2))
    return language.score_language(docs, model).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules.quality_rules(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under links of 90 % common 3-word shingles."""
    return jaccard_join.similar_texts(documents(spark, folder))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Best phrases of every language."""
    return collocations.collocations(documents(spark, folder))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, a letter dropped from one run in 31, with their more frequent near words."""
    runs = spelling.letter_runs(documents(spark, folder), spelling.SHORTEST).select(
        "run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")).alias("h")
    )
    place = F.pmod("h", F.length("run").cast("bigint")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, dropped).otherwise(F.col("run"))
    return spelling.variants(stored(spelling.word_counts(word, runs), "spelling-words"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_model": op1_quality_model,
        "op4_token_count": op4_token_count,
        "op5_packing": op5_packing,
        "op6_personal_data": op6_personal_data,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_decontaminate": op8_decontaminate,
        "op9_language": op9_language,
        "op2_repeated_bytes": op2_repeated_bytes,
        "op3_chat_format": op3_chat_format,
        "op10_quality_rules": op10_quality_rules,
        "op11_jaccard_join": op11_jaccard_join,
        "op12_collocations": op12_collocations,
        "op13_spelling_variants": op13_spelling_variants,
    }
