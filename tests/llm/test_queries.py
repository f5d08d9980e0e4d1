"""The registered queries against DuckDB, and what a session without settings needs."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from adstream.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(values, names, order):
    return sorted(
        (tuple(plain(row[names.index(c)]) for c in order) for row in values), key=str
    )


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF)
    rel = duck.sql(contract.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(rel.columns)
    assert rows([tuple(r) for r in got.collect()], got.columns, order) == rows(
        rel.fetchall(), rel.columns, order
    )


def test_one_query_for_each_operator_and_the_pipeline():
    names = list(contract.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_stages_keep_the_columns_and_the_last_packs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.columns
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == before and docs.count() <= left
        left = docs.count()
    assert left > 150
    pieces = corpus_pipeline.pack_sequences(spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {
        r.doc_id for r in docs.select("doc_id").collect()
    }
