"""Schemas of the tables and streams this package reads and writes."""

from pyspark.sql import types as T

# Fixed values in all of these: the field names, which producers and readers share.

# Payload of an ad event. campaign_id and production_timestamp are missing from
# some producers; production_timestamp carries a fraction, so it is a DOUBLE.
AD_EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("ad_id", T.StringType()),
        T.StructField("ad_type", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("campaign_id", T.IntegerType()),
        T.StructField("production_timestamp", T.DoubleType()),
    ]
)

# What a Kafka source delivers; every record transform takes this shape, so a
# folder of such rows can stand in for a topic.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

CTR_RESULT = T.StructType(
    [
        T.StructField("campaign_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("views", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("ctr", T.DoubleType()),
        T.StructField("max_kafka_ts", T.TimestampType()),
    ]
)

SMOOTHED_RESULT = T.StructType(
    [
        T.StructField("window_start", T.StringType()),
        T.StructField("campaign_id", T.IntegerType()),
        T.StructField("clicks", T.IntegerType()),
        T.StructField("view_count", T.IntegerType()),
        T.StructField("ctr", T.DoubleType()),
        T.StructField("max_produce_time", T.LongType()),
    ]
)

MAPPING = T.StructType(
    [
        T.StructField("ad_id", T.StringType()),
        T.StructField("campaign_id", T.IntegerType()),
    ]
)

LATENCY_CURVE = T.StructType(
    [
        T.StructField("throughput", T.IntegerType()),
        T.StructField("latency", T.DoubleType()),
    ]
)

# The part of a streaming progress report that the reports here read.
PROGRESS_JSON = T.StructType(
    [
        T.StructField("runId", T.StringType()),
        T.StructField("batchId", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("numInputRows", T.LongType()),
        T.StructField(
            "eventTime", T.StructType([T.StructField("watermark", T.StringType())])
        ),
        T.StructField(
            "stateOperators",
            T.ArrayType(
                T.StructType([T.StructField("numRowsDroppedByWatermark", T.LongType())])
            ),
        ),
        T.StructField(
            "sink", T.StructType([T.StructField("description", T.StringType())])
        ),
    ]
)
