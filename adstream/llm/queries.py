"""The registered queries of this subpackage, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm import (
    decontamination,
    divergence,
    language_id,
    licences,
    multi_index,
    quality,
    secret_scan,
    segment_dedup,
    toxicity,
    warc,
    whitening,
)
from adstream.llm.ngram_join import Similarity, jaccard_components
from adstream.llm.packing import pack
from adstream.llm.sql import ORACLES
from adstream.llm.tables import reachable, table

Query = Callable[[SparkSession, str], DataFrame]


def warc_bundles(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    )


def scan_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in secret_scan.BASE],
        F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return segment_dedup.repeated_spans(table(spark, sf, "documents"))


def packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(table(spark, sf, "documents"), Similarity(width=4, percent=85))


def _judged(scored: DataFrame, held: Column, least: float) -> DataFrame:
    score = F.col(scored.columns[-1])
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        score.alias("score"),
        (score >= least).cast("int").alias("predicted"),
    )


def toxic_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs, held = table(spark, sf, "documents"), toxicity.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, sf, "labels"), ~held)
    return _judged(toxicity.scored(docs, model), held, 0.5)


def languages(spark: SparkSession, sf: str) -> DataFrame:
    docs, held = table(spark, sf, "documents"), toxicity.held_out(F.col("doc_id"), 3, 1)
    model = language_id.fit(docs, ~held)
    made = language_id.predicted(docs, model)
    language, score = made.columns[-2:]
    return made.select(
        "doc_id",
        held.alias("held_out"),
        F.col(language).alias("lang_pred"),
        F.col(score).alias("score"),
    )


def licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files of their source and language: source/lang/doc_id."""
    path = F.concat_ws("/", "source", "lang", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    files = table(spark, sf, "documents").select(path.alias("path"), "text")
    return licences.scan(files)


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf, "embeddings"))


def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs, held = table(spark, sf, "documents"), toxicity.held_out(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, table(spark, sf, "labels"), ~held)
    return _judged(quality.scored(docs, model), held, 0.3)


def source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence(table(spark, sf, "documents"))


def whitened_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(table(spark, sf, "embeddings"), "vec_id", "embedding")


def _with_package(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    made = {
        "op1_warc_bundles": warc_bundles,
        "op2_decontamination": decontaminate,
        "op3_secret_scan": scan_secrets,
        "op4_packing": packing,
        "op5_segment_dedup": segments,
        "op6_ngram_jaccard": ngram_jaccard,
        "op7_toxicity": toxic_scores,
        "op8_language_id": languages,
        "op9_licences": licence_scan,
        "op10_multi_index": embeddings,
        "op11_quality_trees": quality_scores,
        "op12_source_divergence": source_divergence,
        "op13_whitening": whitened_embeddings,
    }
    return {name: _with_package(query) for name, query in made.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
