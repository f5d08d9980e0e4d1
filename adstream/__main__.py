"""Jobs for spark-submit: ``python -m adstream <job> ...``.

Sources and sinks are topics (``kafka://host:9092/topic``) or folders.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.operators import latency, progress
from adstream.operators.counts import DELAY, WINDOW
from adstream.operators.records import result_records, smoothed_result_records
from adstream.plans import ctr_from_records, ctr_left_join, ctr_one_pass, ctr_smoothed
from adstream.session import build_session
from adstream.sources import (
    FileFolder,
    endpoint,
    read_events,
    read_latencies,
    read_latency_curve,
    read_lines,
    read_results,
    write_events,
    write_latency,
)
from adstream.streaming import ProgressStore, run_available, start

FORMS = {"left-join": ctr_left_join, "one-pass": ctr_one_pass, "smoothed": ctr_smoothed}


def ctr(spark: SparkSession, args: argparse.Namespace) -> None:
    """Windowed click-through rates from an event topic to a result topic."""
    form = FORMS[args.form]
    rates = ctr_from_records(
        read_events(spark, endpoint(args.source)), form, args.window, args.delay
    )
    encode = smoothed_result_records if form is ctr_smoothed else result_records
    sink = endpoint(args.sink)
    store = ProgressStore(spark, args.progress) if args.progress else None
    if store:
        spark.streams.addListener(store)
    try:
        if args.available_now:
            run_available(encode(rates), sink, args.checkpoint, args.partitions)
        else:
            query = start(encode(rates), sink, args.checkpoint, args.interval, args.partitions)
            query.awaitTermination()
    finally:
        if store:
            store.wait()
            spark.streams.removeListener(store)


def measure(spark: SparkSession, args: argparse.Namespace) -> None:
    """Latencies of all results written so far, appended to a file of samples."""
    smoothed = args.form == "smoothed"
    results = read_results(spark, endpoint(args.results), smoothed)
    by_window = latency.window_latency_smoothed if smoothed else latency.window_latency
    write_latency(by_window(results), args.out, args.run_id)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """A table of ad events as keyed records."""
    write_events(spark.read.parquet(args.table), endpoint(args.sink))


def average(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Mean of each run in a file of samples, or of one of them."""
    samples = read_latencies(spark, args.path)
    if args.run_id is not None:
        samples = samples.filter(F.col("run_id") == args.run_id)
    return latency.latency_average(samples)


def curve(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Latency by throughput, from a CSV file."""
    return latency.latency_curve(read_latency_curve(spark, args.path))


def watermark_log(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Watermark against processing time, from a log."""
    return progress.watermark_log(read_lines(spark, args.path))


def watermark_lag(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Lag of the watermark in each batch, from stored progress reports."""
    return progress.watermark_lag(progress.progress_rows(read_lines(spark, args.path)))


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="adstream", description=__doc__)
    jobs = parser.add_subparsers(required=True)

    job = jobs.add_parser("ctr", help=ctr.__doc__)
    job.set_defaults(job=ctr)
    job.add_argument("--source", required=True)
    job.add_argument("--sink", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--form", choices=FORMS, default="one-pass")
    job.add_argument("--window", default=WINDOW)
    job.add_argument("--delay", default=DELAY)
    job.add_argument("--interval", help="fixed trigger, such as '1 second'")
    job.add_argument("--partitions", type=int, help="state partitions of a new checkpoint")
    job.add_argument("--available-now", action="store_true")
    job.add_argument("--progress", help="folder for progress reports")

    job = jobs.add_parser("measure", help=measure.__doc__)
    job.set_defaults(job=measure)
    job.add_argument("--results", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--run-id", required=True)
    job.add_argument("--form", choices=FORMS, default="one-pass")

    job = jobs.add_parser("publish", help=publish.__doc__)
    job.set_defaults(job=publish)
    job.add_argument("--table", required=True)
    job.add_argument("--sink", required=True)

    for report in (average, curve, watermark_log, watermark_lag):
        job = jobs.add_parser(report.__name__.replace("_", "-"), help=report.__doc__)
        job.set_defaults(job=report)
        job.add_argument("path")
        job.add_argument("--out", required=True, help="folder for the report")
        if report is average:
            job.add_argument("--run-id", help="this run only")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    report = args.job(spark or build_session(), args)
    if report is not None:
        sink = FileFolder(args.out)
        report.write.format(sink.format).save(sink.path)


if __name__ == "__main__":
    main()
