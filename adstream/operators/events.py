"""From raw records to ad events, and row-wise operators on ad events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstream.functions import event_timestamp
from adstream.schemas import AD_EVENT

CORRUPT = "corrupt_record"

# The payload's own campaign id, beside the one in the record key.
PAYLOAD_CAMPAIGN = "payload_campaign_id"


def _output_name(field: str) -> str:
    return PAYLOAD_CAMPAIGN if field == "campaign_id" else field


def parse_ad_events(
    records: DataFrame,
    fields: Sequence[str] | None = None,
    keep_corrupt: bool = True,
) -> DataFrame:
    """Decode keyed JSON records into ad events.

    ``campaign_id`` is the record key, ``kafka_ts`` the record time, ``event_ts``
    the payload's event time; the payload's campaign is ``payload_campaign_id``.
    A text that does not parse gives NULL fields, with the text in
    ``corrupt_record``; a missing text counts as an empty one. Decoding dominates the cost of a query over a topic, so
    name the ``fields`` it uses.
    """
    payload = [f for f in AD_EVENT if fields is None or f.name in fields]
    options = {}
    if keep_corrupt:
        payload.append(T.StructField(CORRUPT, T.StringType()))
        options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = records.select(
        F.col("key").cast("string").alias("campaign_id"),
        F.col("timestamp").cast("timestamp").alias("kafka_ts"),
        json_columns(F.col("value").cast("string"), T.StructType(payload), options).alias(
            *[_output_name(f.name) for f in payload]
        ),
        F.col("value").isNull().alias("missing"),
    )
    if keep_corrupt:
        text = F.coalesce(CORRUPT, F.when(F.col("missing"), F.lit("")))
        parsed = parsed.withColumn(CORRUPT, text)
    parsed = parsed.drop("missing")
    return with_event_ts(parsed) if "event_time" in parsed.columns else parsed


def json_columns(
    text: Column, schema: T.StructType, options: dict[str, str] | None = None
) -> Column:
    """The fields of a JSON text as columns, decoded once per row.

    A plain ``from_json`` is copied into every filter on its fields that moves
    below it, and then runs once more for each; filters stop at a generator.
    """
    return F.inline(F.array(F.from_json(text, schema, options)))


def may_be_of_kind(records: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Skip records whose text cannot hold an event of one of ``kinds``.

    A search of the text is far cheaper than decoding it, and exact: a text
    without the word could hold it only in escaped form, and texts with a
    backslash stay.
    """
    text = F.col("value").cast("string")
    possible = text.contains("\\")
    for kind in kinds:
        possible = possible | text.contains(kind)
    return records.filter(possible)


def drop_unparsed(events: DataFrame) -> DataFrame:
    """Skip records that did not parse: without a text, or with one of which no field
    could be read.

    Valid JSON without a known field stays. Needs the corrupt texts that
    ``parse_ad_events`` keeps.
    """
    payload = [n for n in map(_output_name, AD_EVENT.fieldNames()) if n in events.columns]
    read = F.coalesce(*[F.col(n).cast("string") for n in payload]).isNotNull()
    return events.filter(F.col(CORRUPT).isNull() | read)


def with_event_ts(events: DataFrame) -> DataFrame:
    """Add ``event_ts`` from the epoch milliseconds in ``event_time``."""
    return events.withColumn("event_ts", event_timestamp(F.col("event_time")))


def filter_views(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "view")


def filter_clicks(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "click")


def campaign_event_times(events: DataFrame) -> DataFrame:
    """Campaign and event time only, to watch the watermark move."""
    return events.select("campaign_id", "event_ts")
