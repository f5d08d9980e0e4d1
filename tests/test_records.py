"""Records in and out."""

import json

from pyspark.sql import functions as F

from adstream.operators import events, records
from adstream.plans import ctr_left_join, ctr_one_pass
from adstream.schemas import ENVELOPE
from adstream.sources import FileFolder, read_events, read_results, write_results
from helpers import BASE, GOLDEN, ad_events, envelopes, payload, texts

GOOD = json.dumps(payload("view", 1000, user_id="u", production_timestamp=BASE + 0.5))
TEXTS = {
    "good": GOOD,
    "unknown field": json.dumps(payload("view", 1000, colour="red")),
    "repr": str(payload("view", 1000)),
    "repr with None": str(payload("view", 1000, ip_address=None)),
    "cut off": GOOD[:30],
    "no json": "not json",
    "empty object": "{}",
    "null": None,
    "quoted time": json.dumps({"event_type": "view", "event_time": str(BASE)}),
}


def _parsed(spark, **options):
    rows = [(name, text, 1000) for name, text in TEXTS.items()]
    df = events.parse_ad_events(envelopes(spark, rows), **options)
    return {r["campaign_id"]: r for r in df.collect()}


def test_every_record_stays(spark):
    assert set(_parsed(spark)) == set(TEXTS)
    assert set(_parsed(spark, fields=["event_type"], keep_corrupt=False)) == set(TEXTS)


def test_good_texts(spark):
    rows = _parsed(spark)
    for name in ("good", "unknown field", "repr"):
        assert rows[name]["event_type"] == "view", name
        assert rows[name]["event_time"] == BASE + 1000
        assert rows[name]["corrupt_record"] is None
    assert rows["good"]["production_timestamp"] == BASE + 0.5
    assert rows["good"]["user_id"] == "u"
    assert rows["good"]["payload_campaign_id"] is None


def test_bad_texts_keep_their_text(spark):
    rows = _parsed(spark)
    for name in ("repr with None", "cut off", "no json", "quoted time"):
        assert rows[name]["corrupt_record"] == TEXTS[name], name
        assert rows[name]["event_ts"] is None
    assert rows["quoted time"]["event_type"] == "view"


def test_drop_unparsed(spark):
    rows = [(name, text, 1000) for name, text in TEXTS.items()]
    kept = events.drop_unparsed(events.parse_ad_events(envelopes(spark, rows)))
    assert {r["campaign_id"] for r in kept.collect()} == {
        "good",
        "unknown field",
        "repr",
        "quoted time",
        "empty object",
    }


def test_broken_records_form_no_group(spark):
    rows = [(name, text, 1000) for name, text in TEXTS.items()]
    df = events.parse_ad_events(envelopes(spark, rows))
    for form in (ctr_left_join, ctr_one_pass):
        assert {r["campaign_id"] for r in form(df).collect()} == {
            "good",
            "unknown field",
            "repr",
        }


def test_event_records_round_trip(spark):
    df = ad_events(spark, GOLDEN)
    coded = records.event_records(
        df,
        keep=[
            F.lit("t").alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("bigint").alias("offset"),
            F.col("kafka_ts").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        ],
    )
    assert [f.dataType for f in coded.schema] == [f.dataType for f in ENVELOPE]
    columns = [c for c in df.columns if c != "production_timestamp"]
    back = events.parse_ad_events(coded)
    assert texts(back, *columns) == texts(df, *columns)


def test_event_record_leaves_out_missing_fields(spark):
    row = records.event_records(ad_events(spark, [("7", "view", 0)])).first()
    assert bytes(row["key"]) == b"7"
    assert json.loads(bytes(row["value"])) == {
        "event_type": "view",
        "event_time": BASE,
        "campaign_id": 7,
        "production_timestamp": float(BASE),
    }


def test_result_records(spark):
    ctr = ctr_left_join(ad_events(spark, [("1", "view", 1000), ("1", "click", 2000)]))
    row = records.result_records(ctr).first()
    assert row["key"] == "1"
    assert json.loads(row["value"]) == {
        "campaign_id": "1",
        "window_start": "2025-11-19T23:37:20.000Z",
        "window_end": "2025-11-19T23:37:30.000Z",
        "views": 1,
        "clicks": 1,
        "ctr": 1.0,
        "max_kafka_ts": "2025-11-19T23:37:22.000Z",
    }


def test_results_through_a_folder(spark, tmp_path):
    ctr = ctr_left_join(ad_events(spark, GOLDEN))
    appended = records.result_records(ctr).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("results").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.timestamp_millis(F.lit(BASE + 12000)).alias("timestamp"),
        F.lit(1).alias("timestampType"),
    )
    sink = FileFolder(str(tmp_path / "results"))
    write_results(appended, sink)
    write_results(appended.limit(0), sink)
    back = read_results(spark, sink)
    assert texts(back, *ctr.columns) == texts(ctr, *ctr.columns)
    assert {r[0] for r in back.select(F.unix_millis("append_ts")).collect()} == {BASE + 12000}
    assert read_events(spark, sink, streaming=False).count() == ctr.count()


def test_times_with_an_offset(spark):
    text = json.dumps(
        {
            "campaign_id": "1",
            "window_start": "2025-11-20T07:27:20.000+05:30",
            "max_kafka_ts": "2025-11-20T07:27:28.492+05:30",
        }
    )
    row = records.parse_results(envelopes(spark, [("1", text, 0)]))
    assert texts(row, "window_start", "max_kafka_ts") == [
        ("2025-11-20 01:57:20", "2025-11-20 01:57:28.492")
    ]
