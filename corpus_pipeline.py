"""Stages that make packed training sequences of the documents table.

Each stage works on what the one before kept: toxic documents go, one document of
each group of near duplicates stays, documents that leak benchmark passages go,
secrets are marked out, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm import decontamination, ngram_join, packing, secret_scan, toxicity
from adstream.llm.tables import reachable, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by a model of all labelled documents."""
    reachable(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.scored(docs, model)
    return scored.where(F.col(scored.columns[-1]) < 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked at five words and a similarity of 0.8."""
    reachable(spark)
    return ngram_join.representatives(docs, ngram_join.Similarity())


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    reachable(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each reported secret."""
    return secret_scan.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences, with their ids."""
    reachable(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mark_secrets),
    ("packing", pack_sequences),
]

# The toxicity model and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
