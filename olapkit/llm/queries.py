"""Registered queries of the training-data operators: key -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (alignment, collocations, licences, lm_score, mixing, ngram_join, packing, pii, quality_knn,
               quality_rules, topk, toxicity, warc)
from .common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer file of the installed package of public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by class-conditional Kneser-Ney models."""
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule bitmask ledger over all documents, judged by the default policy."""
    return quality_rules.report(_table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-discrepancy source schedule over all documents."""
    return mixing.report(_table(spark, sf_dir, "documents"))


def op3_archive_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as legacy archives, converted to WARC, and read back."""
    return warc.report(_table(spark, sf_dir, "pages"))


def op4_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 20 by inner product, without random access."""
    return topk.report(_table(spark, sf_dir, "embeddings"))


def op5_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, with identifiers found by bootstrapped contexts."""
    return pii.report(_table(spark, sf_dir, "documents"))


def op6_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by votes of their nearest labelled neighbours."""
    return quality_knn.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join of all documents by vertical partitioning."""
    return ngram_join.report(_table(spark, sf_dir, "documents"))


def op8_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of all documents between conversations (target) and documents (background)."""
    return lm_score.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "conversations"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector bin packing of all documents."""
    return packing.report(_table(spark, sf_dir, "documents"), vocabulary())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase collocations of all documents per language, counted in counting quotient filters."""
    return collocations.report(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned in all documents, with corpus-wide counts of linked ids."""
    return alignment.report(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op13_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and texts in all documents, by a suffix automaton's matching statistics."""
    return licences.report(_table(spark, sf_dir, "documents"))


def _registered(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(job)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return job(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _registered(f) for f in (
    op1_toxicity, op2_quality_rules, op3_archive_converter, op4_nra_topk, op5_contextual_pii, op6_quality_neighbours,
    op7_ngram_jaccard, op8_cross_entropy_difference, op9_vector_packing, op10_source_mix, op11_collocations,
    op12_token_alignment, op13_licence_scan)}

ORACLE_SQL: dict[str, str] = {"op2_quality_rules": quality_rules.op2_sql(), "op3_archive_converter": warc.OP3_SQL,
                              "op4_nra_topk": topk.OP4_SQL, "op10_source_mix": mixing.OP10_SQL,
                              "op11_collocations": collocations.op11_sql()}
