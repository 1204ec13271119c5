"""A cleaning pipeline over `documents`: language ID, exact and near de-duplication, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next stage's docs.  All but the last return the columns of documents; the last adds piece_ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import decontaminate, exact_dedup, language_id, ngram_join, sentencepiece_codec
from sieveline.llm.common import stored
from sieveline.llm.queries import prepare, table


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without letters go too."""
    prepare(spark)
    return language_id.drop_rejected(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row of largest doc_id."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links of similarity 0.75 or more, the one of smallest doc_id."""
    prepare(spark)
    return ngram_join.drop_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, with their piece ids."""
    prepare(spark)
    return sentencepiece_codec.encode_documents(docs)


STAGES = [
    ("language_id", recognised),
    ("exact_dedup", distinct),
    ("ngram_jaccard", dissimilar),
    ("decontamination", uncontaminated),
    ("sentencepiece", encoded),
]

#: The language models have no SQL form; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
