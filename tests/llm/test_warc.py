import base64
import hashlib

import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F

from adstream.llm import warc

ROWS = [
    (1, "http://a/%0A\n", "<p>é</p>"),
    (3, None, "<p>é</p>"),
    (2, "http://b", "<p>é</p>"),
    (5, "http://c", None),
    (4, "http://d", ""),
    (None, "http://e", ""),
    (6, "http://f", "x" * 3_000_000),
    (7, "http://g", "one"),
    (7, "http://g", "one"),
]
SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def found(df):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()),
        key=str,
    )


def test_round_trip_with_nulls_empties_ties_and_long_payloads(spark):
    pages = spark.createDataFrame([(*r, "y", 1) for r in ROWS], SCHEMA + ", offset string, frame int")
    first = {"<p>é</p>": 1, "": 4, "x" * 3_000_000: 6, "one": 7}
    wanted = []
    for page, _, html in ROWS:
        to = first[html or ""]
        wanted.append((
            page, len((html or "").encode()), digest(html),
            "response" if page == to else "revisit", None if page == to else to,
        ))
    assert found(warc.round_trip(pages)) == sorted(wanted, key=str)


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    made = warc.round_trip(pages, warc.Bundling(revisit_bytes=4))
    kinds = {(r.page_id, r.record_type) for r in made.collect()}
    assert (5, "response") in kinds and (4, "response") in kinds and (3, "revisit") in kinds


def test_records_lie_in_frames_that_open_alone(spark):
    rows = [(k, f"http://{k}", f"{k} " * 300) for k in range(60)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(2)
    how = warc.Bundling(frame_bytes=5_000, bundle_bytes=20_000)
    folder = warc.archive_folder(pages, "warc")
    index = warc.write_archive(warc.with_revisits(pages), folder, how)
    store, path = fs.FileSystem.from_uri(folder)
    names = {r.bundle for r in index.select("bundle").distinct().collect()}
    assert len(names) > 2
    for name in names:
        with store.open_input_file(f"{path}/{name}") as source:
            assert len(warc.seek_table(source)) > 1
    part = warc.read_archive(index.where("page_id in (7, 31)"), folder)
    assert {(r.page_id, r.url, bytes(r.payload).decode()) for r in part.collect()} == {rows[7], rows[31]}


def test_damage_is_found():
    record = warc._record(1, "u", b"abc", 3, digest("abc"), None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)[4] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"))


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_records_are_read_by_several_tasks(spark, monkeypatch):
    pages = spark.createDataFrame([(k, f"u{k}", f"<p>{k}</p>" * 50) for k in range(200)], "page_id long, url string, html string")
    folder = warc.archive_folder(pages, "warc")
    index = warc.write_archive(warc.with_revisits(pages), folder, warc.Bundling(frame_bytes=2048))
    monkeypatch.setattr(warc, "READ_BYTES", 20_000)
    made = warc.read_archive(index, folder).withColumn("task", F.spark_partition_id())
    assert made.count() == 200
    assert made.select("task").distinct().count() > 1
