"""Every registered query against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.01"

LLM = contract.llm_queries.queries().keys() | {"pipeline"} if contract.llm_queries else set()
QUERIES = {n: q for n, q in contract.queries().items() if n not in LLM}
ORACLES = {n: q for n, q in contract.oracle_sql().items() if n not in LLM}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _sortable(row):
    return [(v is None, "" if v is None else v) for v in row]


def _rows(rows, names, order):
    picked = [tuple(row[names.index(c)] for c in order) for row in rows]
    return sorted(picked, key=lambda r: [(n, str(v)) for n, v in _sortable(r)])


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rel = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(rel.columns)
    order = sorted(got.columns)
    mine = _rows([tuple(r) for r in got.collect()], got.columns, order)
    theirs = _rows(rel.fetchall(), rel.columns, order)
    assert len(mine) == len(theirs)
    assert len(mine) > 0
    for a, b in zip(mine, theirs):
        assert all(_same(x, y) for x, y in zip(a, b)), (order, a, b)
