"""From raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept.
Every stage but the last returns the columns of ``documents``; each result is written as Parquet and read again, so
a lost executor costs one stage's tasks at most.

1. ``language``: documents without a recognisable language go (``und`` or a score below 0.3).
2. ``line_dedup``: lines of 20 characters or more found in three documents stay in the one with the largest doc_id.
3. ``near_dedup``: one document of each group of near copies stays (five-word shingles, similarity 0.8).
4. ``mixing``: documents are repeated or left out to reach the source targets.
5. ``packing``: token pieces placed in sequences of 1024.

Defined cases are those of the operators; a stage that keeps nothing hands on an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screenmeld.llm import language, line_dedup, mixing, neardup, packing
from screenmeld.llm.queries import documents, vocabulary
from screenmeld.session import stage

LEAST_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs, least=LEAST_LANGUAGE_SCORE)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, **vocabulary())


STAGES = [("language", language_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

#: Tokens, random fields and sampling are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
