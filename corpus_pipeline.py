"""The corpus pipeline: five stages from raw documents to packed sequences.

1. Toxic documents go.
2. Of similar lines one stays; documents with no line left go.
3. Of near-duplicate documents one stays.
4. Secrets are replaced by a placeholder.
5. What is left is packed into sequences of permitted lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import Scratch, documents, table
from tidemark.llm.lines import without_repeated_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.secrets import redact
from tidemark.llm.simhash import without_near_duplicates
from tidemark.llm.toxicity import train


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return train(docs, table(spark, sf_dir, "labels")).clean(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


#: Every stage gets the documents that its predecessor kept; all but the last return the columns of `documents`.
STAGES = [("toxicity", not_toxic), ("line dedup", distinct_lines), ("simhash near-dedup", distinct_documents),
          ("secret scan", redacted), ("best-fit packing", packed)]

#: Scores and fingerprints have no form in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and read again before the next stage."""
    scratch, docs, before = Scratch(spark), documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = scratch.save(name.replace(" ", "-"), stage(spark, docs, sf_dir))
        if before:
            scratch.drop(before)
        before = name.replace(" ", "-")
    return docs
