"""Sources: event and result records, plain text, latency curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.operators.records import parse_results, parse_smoothed_results
from adstream.schemas import ENVELOPE, LATENCY_CURVE
from adstream.sources.endpoints import FileFolder, KafkaTopic

Source = KafkaTopic | FileFolder


def read_events(spark: SparkSession, source: Source, streaming: bool = True) -> DataFrame:
    """Records of a topic, or rows of a folder, as a stream or a bounded table.

    A bounded read of a topic covers everything from the starting offset to the
    newest record, over all its partitions. A folder without a schema of its own
    holds record envelopes.
    """
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, KafkaTopic):
        return reader.format("kafka").options(**source.read_options(streaming)).load()
    return (
        reader.schema(source.schema or ENVELOPE)
        .format(source.format)
        .options(**source.options)
        .load(source.path)
    )


def read_partitions(
    spark: SparkSession, source: Source, partitions: Sequence[int]
) -> dict[int, DataFrame]:
    """Streams of some partitions of a topic, or of a folder written by ``partition``."""
    return {k: read_events(spark, source.only(k)) for k in partitions}


def read_results(spark: SparkSession, source: Source, smoothed: bool = False) -> DataFrame:
    """All result records written so far, decoded, with their append time."""
    records = read_events(spark, source, streaming=False)
    return parse_smoothed_results(records) if smoothed else parse_results(records)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``."""
    return spark.read.text(path)


def read_latencies(spark: SparkSession, path: str) -> DataFrame:
    """One number per line; blank lines are skipped, a bad number is an error."""
    lines = read_lines(spark, path)
    number = F.trim("value")
    rest = [c for c in lines.columns if c != "value"]
    return lines.filter(number != "").select(
        *rest, number.cast("double").alias("latency_ms")
    )


def read_latency_curve(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the header ``throughput,latency``."""
    return (
        spark.read.schema(LATENCY_CURVE)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .csv(path)
    )
