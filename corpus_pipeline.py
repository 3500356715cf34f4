"""From raw documents to packed sequences: language, lines, near duplicates, benchmark passages, packing."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language, lines, packing, shingles, simhash
from tidemark.llm.common import staged, table

#: Bytes of texts that reach a Python worker at once. A batch is held several times over, by Arrow in the executor and by the worker, and neither gives all of that memory back.
BATCH_BYTES = "4m"


def small_batches(stage):
    """The stage, under a session whose Arrow batches end at BATCH_BYTES; it stays set, as what a stage returns runs later. A longer text still comes whole."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network (learned from docs) tells; `und` and doubtful ones go."""
    return language.keep_known(docs, language.fit(docs))


@small_batches
def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that resemble an earlier line; blank lines stay."""
    return lines.without_repeats(docs, counts=False)


@small_batches
def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of Jaccard index 0.8 or more, over shingles of five words, hold together; fingerprints in BK-trees (as in op3) and MinHash name the pairs that are compared."""
    return simhash.keep_one(docs, groups=shingles.near_duplicates)


@small_batches
def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack_documents(docs, packing.tokenizer(), remembered=200_000)  # beside what the stages before it leave in the executors


STAGES = [
    ("language", known_language),
    ("lines", distinct_lines),
    ("near_duplicates", distinct_documents),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: SQL expresses neither the network nor the join of similar lines; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each on what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
