"""Corpus pipeline over the documents table: from raw documents to packed token sequences.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; each result is written as Parquet and read again as the
next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from olapkit.llm import mixing, ngram_join, packing, pii, quality_rules
from olapkit.llm.common import ship, stored
from olapkit.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default quality policy."""
    return quality_rules.accepted(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (smallest id)."""
    ship(spark)
    return ngram_join.distinct_documents(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and learned identifiers masked by their kind."""
    ship(spark)
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents repeated or cut as the schedule takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, packed under the limits on tokens, segments and loss-bearing tokens."""
    ship(spark)
    return packing.report(docs, vocabulary())


STAGES = [("quality rules", quality), ("n-gram Jaccard join", deduplicate), ("PII", privacy),
          ("source mix", mix), ("packing", pack)]

#: Learned contexts and token ids have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
