"""What the physical plans must look like, as the data grows."""

import re

import pytest

import __spark_entry__ as contract
from adstream.operators import arrivals, events
from adstream.plans import ctr_from_records, ctr_left_join, ctr_one_pass, ctr_smoothed
from adstream.sources import event_table
from helpers import GOLDEN, ad_events

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table_events(spark):
    return event_table.ad_events(event_table.read_table(spark, SF))


def test_one_pass_is_one_scan_and_one_shuffle(table_events):
    text = plan(ctr_one_pass(table_events))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "In(event_type, [click,view])" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_smoothed_is_one_scan_and_one_shuffle(table_events):
    text = plan(ctr_smoothed(table_events))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_join_adds_no_shuffle_to_its_aggregates(spark, table_events):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ctr_left_join(table_events))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2
    assert "SortMergeJoin" in text
    assert "EqualTo(event_type,view)" in text and "EqualTo(event_type,click)" in text


@pytest.mark.parametrize("form", [ctr_left_join, ctr_one_pass, ctr_smoothed])
def test_records_are_decoded_once_per_scan(spark, tmp_path, form):
    table = event_table.read_table(spark, SF)
    event_table.envelopes(table).write.parquet(str(tmp_path / "env"))
    text = plan(ctr_from_records(spark.read.parquet(str(tmp_path / "env")), form))
    assert text.count("from_json") == text.count("FileScan")
    assert "ip_address" not in text
    columns = "key:binary,value:binary,timestamp:timestamp"
    if form is ctr_smoothed:
        columns = "value:binary"
    assert f"ReadSchema: struct<{columns}>" in text


def test_all_sides_aggregate_before_the_shuffle(table_events):
    for df in (ctr_left_join(table_events), arrivals.bucket_counts(table_events, "1 second")):
        text = plan(df)
        assert len(re.findall(r"partial_count", text)) >= text.count("Exchange hash")


def test_gaps_never_sort_a_whole_campaign(table_events):
    text = plan(arrivals.arrival_gaps(table_events))
    # Events are sorted by campaign and bucket; only bucket rows by campaign.
    sorts = re.findall(r"Sort \[([^\]]*)\]", text)
    assert len(sorts) == 2
    assert sum("bucket" in s and "at#" in s for s in sorts) == 1


@pytest.mark.parametrize("name", sorted(contract._all_queries()))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval", "MapInPandas"):
        assert word not in text, word


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "campaign_id",
        "window_start",
        "window_end",
        "views",
        "clicks",
        "ctr",
        "max_kafka_ts",
    ]
    assert df.count() > 0


def test_corrupt_column_is_optional(spark):
    df = ad_events(spark, GOLDEN)
    assert events.CORRUPT not in df.columns
