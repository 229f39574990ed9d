"""The corpus pipeline: five stages over ``documents``, in this order.

Each stage calls one operator on all that its predecessor kept.  All but the
last return the columns of ``documents``; ``run`` writes every stage's result
below the session's shared checkpoint folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from surveylake.llm import decontam, langid, linededup, packing, simhash
from surveylake.llm.common import materialise, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go (all, if no language could be learned)."""
    return langid.recognised(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines of 50 words or more stay where they stand first; a document
    that loses four fifths of its words so is a near copy, and goes."""
    return linededup.without_repeated_lines(docs, min_words=50, most_repeated=0.8)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.representatives(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a 10-word window with the benchmark go."""
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all that is left, in sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=1)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packed)]

#: No SQL: XXH64 fingerprints, language scores and BPE tokens have no DuckDB
#: equivalent.  tests/llm compares the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
