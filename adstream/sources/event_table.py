"""A plain event table as ad events, record envelopes, ads and a mapping.

The table has event_id, ts (without zone, meaning UTC), user_id, event_type and
props. A user stands for an ad, and the last digit of its id for the campaign.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.operators.events import PAYLOAD_CAMPAIGN
from adstream.operators.records import event_records

TABLE_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, "
    "event_type string, value double, props string"
)
FILE = "events.parquet"


def path(folder: str) -> str:
    return f"{folder.rstrip('/')}/{FILE}"


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(path(folder))


def stream_table(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """The table as a stream, be it one file or a folder of part files.

    Bound a micro-batch by files or by bytes (such as ``"64g"``) where the table is
    large, so that a lost executor repeats one batch and not all. Files are taken by
    their time of change: where that is not the order of their events, rows of later
    files can come late, so give a longer delay or leave the bound out.
    """
    reader = spark.readStream.schema(TABLE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    # A stream reads folders, or what a pattern matches; this one has one match.
    return reader.parquet(f"{path(folder)[:-1]}[{FILE[-1]}]")


def ad_events(table: DataFrame) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    campaign = F.col("user_id") % 10
    return table.select(
        "event_id",
        campaign.cast("string").alias("campaign_id"),
        at.alias("kafka_ts"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("page_id"),
        F.col("user_id").cast("string").alias("ad_id"),
        "event_type",
        F.unix_millis(at).alias("event_time"),
        campaign.cast("int").alias(PAYLOAD_CAMPAIGN),
        F.unix_millis(at).cast("double").alias("production_timestamp"),
        at.alias("event_ts"),
    )


def envelopes(table: DataFrame, topic: str = "ad-events") -> DataFrame:
    """The table's events as a topic would deliver them."""
    return event_records(
        ad_events(table),
        keep=[
            F.lit(topic).alias("topic"),
            (F.col(PAYLOAD_CAMPAIGN) % 4).alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("kafka_ts").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        ],
    )


def ads(table: DataFrame) -> DataFrame:
    """Distinct ads with their running number."""
    return table.select(
        F.col("user_id").cast("string").alias("ad_id"),
        F.col("user_id").alias("ad_index"),
    ).distinct()


def mapping(table: DataFrame) -> DataFrame:
    """Campaign of each ad."""
    return table.select(
        F.col("user_id").cast("string").alias("ad_id"),
        (F.col("user_id") % 10).cast("int").alias("campaign_id"),
    ).distinct()
