"""Keyed JSON records: events and results, out and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstream.operators.events import PAYLOAD_CAMPAIGN, json_columns
from adstream.schemas import AD_EVENT, CTR_RESULT, SMOOTHED_RESULT


def event_records(
    events: DataFrame,
    fields: Sequence[str] | None = None,
    key: str | Column = "campaign_id",
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """Ad events as records: key is the campaign, value the event as JSON.

    ``fields`` defaults to all payload fields that ``events`` has. ``keep`` adds
    columns beside the record, such as the ``partition`` a Kafka sink may be given.
    """
    source = {f.name: f.name for f in AD_EVENT}
    if PAYLOAD_CAMPAIGN in events.columns:
        source["campaign_id"] = PAYLOAD_CAMPAIGN
    names = fields or [n for n in AD_EVENT.fieldNames() if source[n] in events.columns]
    payload = F.struct(
        *[F.col(source[n]).cast(AD_EVENT[n].dataType).alias(n) for n in names]
    )
    key_column = F.col(key) if isinstance(key, str) else key
    return events.select(
        key_column.cast("string").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        *keep,
    )


def result_records(ctr: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
    """CTR rows as records keyed by campaign. JSON times carry milliseconds."""
    return ctr.select(
        F.col("campaign_id").cast("string").alias("key"),
        F.to_json(F.struct(*CTR_RESULT.fieldNames())).alias("value"),
        *keep,
    )


def smoothed_result_records(
    ctr: DataFrame, keep: Sequence[str | Column] = ()
) -> DataFrame:
    """Smoothed CTR rows as records without a key."""
    value = F.to_json(F.struct(*SMOOTHED_RESULT.fieldNames())).alias("value")
    return ctr.select(value, *keep)


def parse_results(records: DataFrame) -> DataFrame:
    """CTR rows from their records, with the time the record was appended."""
    return _decode(records, CTR_RESULT)


def parse_smoothed_results(records: DataFrame) -> DataFrame:
    """Smoothed CTR rows from their records, with the append time."""
    return _decode(records, SMOOTHED_RESULT)


def _decode(records: DataFrame, schema: T.StructType) -> DataFrame:
    return records.select(
        json_columns(F.col("value").cast("string"), schema),
        F.col("timestamp").alias("append_ts"),
    )
