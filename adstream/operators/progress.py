"""Streaming progress reports as tables: watermark, lag, dropped rows, log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.functions import iso_to_millis
from adstream.schemas import PROGRESS_JSON

# The words before the two times in a line of the log.
WATERMARK_WORD, PROCESSING_WORD = "wm=", "processing_time="

# What is not a time is told by reading it as one.
WATERMARK_LINE = rf"(?:^|\s){WATERMARK_WORD}(\S+)\s+{PROCESSING_WORD}(\S+)"


def progress_rows(reports: DataFrame) -> DataFrame:
    """One row per progress report, from its JSON text in ``value``."""
    dropped = F.aggregate(
        F.transform(
            "report.stateOperators",
            lambda op: F.coalesce(op["numRowsDroppedByWatermark"], F.lit(0)),
        ),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return reports.select(F.from_json("value", PROGRESS_JSON).alias("report")).select(
        F.col("report.runId").alias("run_id"),
        F.col("report.batchId").alias("batch_id"),
        F.col("report.timestamp").alias("timestamp"),
        F.col("report.eventTime.watermark").alias("watermark"),
        F.col("report.numInputRows").alias("input_rows"),
        F.coalesce(dropped, F.lit(0)).alias("rows_dropped"),
        F.col("report.sink.description").alias("sink"),
    )


def watermark_lag(progress: DataFrame) -> DataFrame:
    """Trigger time less watermark. Rows that have no watermark yet stay out."""
    watermark_ms = iso_to_millis(F.col("watermark"))
    return progress.filter(watermark_ms > 0).select(
        "batch_id",
        "watermark",
        (iso_to_millis(F.col("timestamp")) - watermark_ms).alias("lag_ms"),
    )


def watermark_lines(progress: DataFrame) -> DataFrame:
    """Log lines of progress rows with a watermark: one on it, one on the sink."""
    line = F.concat(
        F.lit(f"watermark {WATERMARK_WORD}"),
        F.col("watermark"),
        F.lit(f" {PROCESSING_WORD}"),
        F.col("timestamp"),
    )
    sink = F.concat(F.lit("sink "), F.coalesce(F.col("sink"), F.lit("")))
    return progress.filter(F.col("watermark").isNotNull()).select(
        F.explode(F.array(line, sink)).alias("value")
    )


def watermark_log(lines: DataFrame) -> DataFrame:
    """Watermark against processing time, from log lines; other lines drop out."""
    found = lines.select(
        F.regexp_extract("value", WATERMARK_LINE, 1).alias("wm"),
        F.regexp_extract("value", WATERMARK_LINE, 2).alias("processing"),
    ).filter(F.col("wm") != "")
    return found.select(
        F.try_to_timestamp("wm").alias("watermark"),
        F.col("processing").try_cast("timestamp_ntz").alias("processing_time"),
    ).dropna()
