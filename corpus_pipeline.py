"""The corpus pipeline: documents to training sequences, in stages that each call one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the ``docs`` of the next one. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import decontam, lines, simhash, toxicity
from furrow.llm.common import Scratch, table
from furrow.llm.queries import packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7).select(COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than 2 % of a source's pages go; every document stays, with its text's new length."""
    kept = lines.drop_boilerplate(docs, ratio=0.02, min_pages=5)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: the smallest doc_id (nulls last), then the smallest text hash."""
    return simhash.keep_one(docs, shingle=3, radius=3).select(COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item's five-word shingles go."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), width=5, threshold=0.8).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, along the space-filling curve."""
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("packing", pack),
]

#: A trained classifier, XXH64 and a tokenizer have no SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages a table in the shared folder, dropped once it has been read."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    last = None
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
