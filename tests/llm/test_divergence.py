import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from adstream.llm import divergence as audit
from adstream.llm import tables
from adstream.llm.sql import ORACLES

from .conftest import LONG

SCHEMA = "doc_id long, text string, lang string, source string, item string, rank int, zero long, block long"


def brute(rows, least=3, ranks=200):
    docs = []
    for text, lang, source in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        docs.append((lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", folded)))
    seen = defaultdict(Counter)
    for lang, _, terms in docs:
        seen[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in seen.items()}
    counts = defaultdict(Counter)
    for lang, source, terms in docs:
        here = [t for t in terms if t in kept[lang]]
        counts[lang, source].update(here)
        counts[lang, None].update(here)

    def part(group, term):
        n, v = sum(counts[group].values()), len(kept[group[0]])
        return 1 + 10**9 * (counts[group][term] + 1) // (n + v)

    def far(p, q):
        return (p - q) ** 2 // q

    made = []
    groups = {(lang, source) for lang, source, _ in docs}
    for lang, source in groups:
        one = (lang, source)
        pairs = [
            (s, sum(far(part(one, t), part((lang, s), t)) for t in kept[lang]))
            for k, s in groups
            if k == lang and s != source
        ]
        terms = [
            (t, far(part(one, t), part((lang, None), t)))
            for t, n in counts[one].items()
            if n and part(one, t) > part((lang, None), t)
        ]
        for name, items, most in (("pair", pairs, None), ("term", terms, ranks)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            made += [(lang, source, name, t, f, k + 1) for k, (t, f) in enumerate(items[:most])]
    return sorted(made)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(k, *r, "x", 1, 2, 3) for k, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in audit.divergence(docs.repartition(3), **how).collect())


def made_rows(draw, n):
    parts = ["an", "be", "Ci", "é", "漢字", "ü", "x" * 9, "y" * 40]
    rows = []
    for _ in range(n):
        words = ["".join(draw.choices(parts, k=draw.randrange(1, 4))) for _ in range(draw.randrange(30))]
        rows.append((draw.choice([" ", "1", "\n", "-"]).join(words), draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "s3", None, ""])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = made_rows(random.Random(seed), 120)
    assert found(spark, rows) == brute(rows)


def test_many_sources(spark):
    """More sources in a block than a square of sums is kept for."""
    rows = [(f"w{chr(97 + k % 5)} all the same", "en", f"s{k % 40}") for k in range(300)]
    table = [r for r in brute(rows) if r[2] == "pair"]
    assert [r for r in found(spark, rows) if r[2] == "pair"] == table


def test_sums_of_pairs_alike_dense_or_not():
    draw = random.Random(4)
    rows = pa.table({
        "lang": ["en"] * 400, "source": [f"s{draw.randrange(9)}{k % 3}" for k in range(400)],
        "term": [f"t{k // 8}".encode() for k in range(400)],
        "p": [draw.randrange(5, 10**6) for _ in range(400)], "zero": [draw.randrange(1, 9) for _ in range(400)],
    })
    rows = rows.group_by(["lang", "source", "term"]).aggregate([("p", "max"), ("zero", "max")])
    rows = rows.rename_columns(["lang", "source", "term", "p", "zero"])
    before = audit.DENSE
    try:
        made = []
        for most in (0, before):
            audit.DENSE = most
            found = audit._both_have(rows).to_pylist()
            made.append({(r["source"], r["item"]): r["value"] for r in found if r["value"]})
    finally:
        audit.DENSE = before
    assert made[0] == made[1] and len(made[0]) > 100


def test_few_ranks_small_blocks_and_crowded_filters(spark, monkeypatch):
    """Bounds that workers see through what the closures carry change no result."""
    rows = made_rows(random.Random(9), 150)
    monkeypatch.setattr(tables, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(audit, "BLOCK_ENTRIES", 7)
    assert found(spark, rows, ranks=3) == brute(rows, ranks=3)


def test_odd_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None, None)]) == []
    rows = [(None, "en", "a"), ("", "en", "b"), ("12 34", "en", None)]
    assert found(spark, rows) == brute(rows) and len(found(spark, rows)) == 6
    rows = [("same words here", "en", "a")] * 5 + [("same words", "en", "b"), ("x", "de", "b")]
    assert found(spark, rows) == brute(rows)


def test_long_texts_and_long_terms(spark, monkeypatch):
    long_term = "né" * 5000
    rows = [(LONG, "en", "a"), (LONG[:5000], "en", "b"), (LONG[100:9000] + " " + long_term, "en", "c")]
    rows += [(f"{long_term} w", "en", "a"), (f"w.{long_term}", "en", "b"), (long_term + "x", "en", "c")]
    assert found(spark, rows) == brute(rows)


def test_pieces_cut_no_term():
    text = (b"Alpha beta1" * 50 + b"z" * 500 + b" 12 ") * 3
    expected = re.findall(rb"[a-z]+", text.lower())
    before = audit.PIECE
    try:
        for size in (1, 7, 64, 10_000):
            audit.PIECE = size
            assert [t for piece in audit._terms(text) for t in piece] == expected
    finally:
        audit.PIECE = before


def test_parts_are_exact_where_longs_would_overflow(spark):
    most = 2**62
    row = spark.createDataFrame([(9_000_000_000, most, 5), (most, most, 10**6), (0, 0, 0)], "times long, n long, v long")
    got = [r[0] for r in row.select(audit._part("times", "n", "v")).collect()]
    assert got == [1 + 10**9 * (t + 1) // max(n + v, 1) for t, n, v in ((9_000_000_000, most, 5), (most, most, 10**6), (0, 0, 0))]


def test_sql_equals_brute_force():
    rows = made_rows(random.Random(21), 80) + [(None, "en", "s1")] * 2
    con = duckdb.connect()
    con.execute("create table documents(text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    columns = "lang, source, part, item, value, rank"
    got = con.sql(f"select {columns} from ({ORACLES['op12_source_divergence']})").fetchall()
    assert sorted(got) == brute(rows)
