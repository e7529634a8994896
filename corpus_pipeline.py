"""Corpus pipeline: language, near duplicates, benchmark leaks, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result to the shared
folder and reads it back for the next stage, so that a lost executor costs the running tasks only. The first
four return the columns of ``documents``; the last returns the pieces of the packed sequences.

Stages keep repeated rows and rows with null ids as their operators define it. SQL cannot express the learned
and the tokenizing stages, so ``ORACLE_SQL`` is null and the tests hold the rows against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import decontaminate, language, minhash, packing, pii
from weekloom.llm.queries import bpe_files
from weekloom.sources.scratch import stored

#: A document whose language is known with less probability is rejected.
LEAST_SURE = 0.5

ORACLE_SQL = None


#: Rows of whole texts that go to a Python worker at once; Spark's default of 10,000 takes some 30 MB, four times over.
ARROW_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a known language; others (no letters, unsure) go."""
    _small_batches(spark)
    return language.in_known_language(docs, language.fit_language(docs), LEAST_SURE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near duplicates: the one with the least id. An id that stands for several texts
    loses those that stay elsewhere only."""
    _small_batches(spark)
    return minhash.without_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    _small_batches(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    _small_batches(spark)
    masked = pii.masked(docs)
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with sequence and offset."""
    _small_batches(spark)
    return packing.pack_documents(docs, bpe_files())


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
