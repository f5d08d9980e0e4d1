"""From windowed results to latency reports, and the records they travel in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.operators.latency import latency_average, latency_curve
from adstream.operators.records import result_records, smoothed_result_records
from adstream.schemas import SMOOTHED_RESULT
from adstream.session import shared_folder
from adstream.sources import read_latencies, read_latency_curve, write_latency


def appended_results(ctr: DataFrame, append_ts: Column, topic: str = "results") -> DataFrame:
    """CTR rows as the result topic would deliver them, appended at ``append_ts``."""
    smoothed = set(SMOOTHED_RESULT.fieldNames()) <= set(ctr.columns)
    timed = ctr.withColumn("append_ts", append_ts)
    make = smoothed_result_records if smoothed else result_records
    key = F.lit(None).cast("string") if smoothed else F.col("key")
    return make(timed, keep=["append_ts"]).select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.col("append_ts").alias("timestamp"),
        F.lit(1).alias("timestampType"),
    )


def average_of_run(spark: SparkSession, latencies: DataFrame, run_id: str) -> DataFrame:
    """Write a run's latencies as a new file of samples and average that run."""
    return average_of_runs(spark, {run_id: latencies}).where(F.col("run_id") == run_id)


def average_of_runs(spark: SparkSession, runs: dict[str, DataFrame]) -> DataFrame:
    """Write the latencies of each run to one file of samples; the mean of each."""
    path = shared_folder(spark, "latency")
    for run_id, latencies in runs.items():
        write_latency(latencies, path, run_id)
    samples = read_latencies(spark, path)
    return latency_average(samples.withColumn("run_id", F.col("run_id").cast("string")))


def curve_of_runs(spark: SparkSession, points: DataFrame) -> DataFrame:
    """Write (throughput, latency) points as a CSV file and read their curve."""
    path = shared_folder(spark, "curve")
    points.write.option("header", True).csv(path)
    return latency_curve(read_latency_curve(spark, path))
