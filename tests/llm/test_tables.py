import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adstream.llm import tables


def test_a_filter_follows_its_keys_and_loses_none(spark, monkeypatch):
    keys = spark.range(50_000).select(F.xxhash64("id").alias("key"))
    held = np.array([r.key for r in keys.collect()], np.int64)
    others = np.array([r.key for r in spark.range(100_000, 150_000).select(F.xxhash64("id").alias("key")).collect()], np.int64)
    found = tables.membership(keys, "key")
    assert tables.passes(found, held).all() and tables.passes(found, others).mean() < 0.05
    assert len(tables.membership(keys.limit(10), "key")) < len(found)
    monkeypatch.setattr(tables, "MOST_BITS", 1 << 16)
    crowded = tables.membership(keys, "key")
    assert len(crowded) == (1 << 16) // 64 and tables.passes(crowded, held).all()
    empty = tables.membership(keys.limit(0), "key")
    assert not tables.passes(empty, held).any()


def test_a_sample_of_equal_rows_is_not_empty(spark):
    equal = spark.range(20_000).select(F.lit("same").alias("x"))
    mixed = equal.unionByName(spark.range(20_000).select(F.concat(F.lit("v"), "id").alias("x")))
    for draw in range(4):
        assert tables.hashed_sample(equal, 100, "x", draw=draw).count() == 100
        assert tables.hashed_sample(mixed, 100, "x", draw=draw).count() == 100


def test_joins_leave_columns_of_any_name_alone(spark):
    one = spark.createDataFrame([(1, "a")], "k int, _join_shard string")
    two = spark.createDataFrame([(1, "b")], "k int, _Join_Shard_ string")
    got = tables.split_join(one, two, ["k"])
    assert [tuple(r) for r in got.collect()] == [(1, "a", "b")]


def test_discarded_tables_are_gone(spark):
    made = tables.stored(spark.range(3), "thing")
    assert made.count() == 3
    tables.discard(made)
    assert not tables.files.exists(spark, made.stored_at)


def test_rows_set_apart_are_whole_and_meet_no_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("id"), F.lit("x").alias("_met"))
    keys = spark.range(100, 300).select(F.xxhash64("id").alias("key"))
    key = F.when(F.col("id").isNotNull(), F.xxhash64("id"))
    sure, rest = tables.set_apart(rows, key, keys, "key")
    assert sure.columns == rest.columns == ["id", "_met"]
    apart, others = ([r.id for r in df.collect()] for df in (sure, rest))
    assert len(apart) + len(others) == 5000 and apart.count(None) == 100
    assert {k for k in range(100, 300) if k % 50} <= set(others) and len(others) < 600


def test_pieces_hold_the_same_rows():
    batch = pa.RecordBatch.from_pydict({"x": list(range(25)), "y": [[k] * k for k in range(25)]})
    made = list(tables.pieces([batch, batch.slice(0, 0)], 10))
    assert [len(b) for b in made] == [10, 10, 5]
    assert pa.Table.from_batches(made).to_pylist() == batch.to_pylist()
