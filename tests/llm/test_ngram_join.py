import random

from adstream.llm import ngram_join
from adstream.llm.ngram_join import Similarity, jaccard_components, representatives

from .test_words import plain


def brute(rows, width, percent):
    sets = [(i, plain(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def changed(words, n, draw):
    words = list(words)
    for k in draw.sample(range(len(words)), n):
        words[k] = f"n{draw.random()}"
    return " ".join(words)


def test_components_are_those_of_all_links(texts):
    draw = random.Random(3)
    common = [f"c{k}" for k in range(60)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a  B"), (6, "a b c"), (None, "a b"), (7, "a b c d e"), (7, "other words of this id here"), (8, "Other words of this id here")]
    for base in range(6):
        words = [f"b{base}w{k}" for k in range(80)] + common
        for copy in range(12):
            rows.append((100 * base + copy + 10, changed(words, copy % 5, draw)))
    rows += [(900 + k, rows[20][1]) for k in range(5)] + [rows[21]]
    docs = texts(rows).repartition(5)
    for like in (Similarity(4, 85), Similarity()):
        assert found(jaccard_components(docs, like)) == brute(rows, like.width, like.percent)


def test_order_of_shingles_changes_nothing(texts, monkeypatch):
    import numpy as np

    draw = random.Random(5)
    rows = [(k, changed([f"w{j}" for j in range(70)], k % 4, draw)) for k in range(25)]
    monkeypatch.setattr(ngram_join, "common_levels", lambda *_: np.zeros(ngram_join.SLOTS, np.uint8))
    assert found(jaccard_components(texts(rows), Similarity(4, 85))) == brute(rows, 4, 85)


def test_one_document_of_each_group_stays(texts):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(3, text), (2, text + " more"), (2, text + " more"), (9, "far other words than those here"), (None, text), (4, None), (5, "")]
    kept = representatives(texts(rows))
    assert kept.columns == texts([]).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "9", "None"]


def test_no_documents(texts):
    assert found(jaccard_components(texts([]))) == [] and representatives(texts([])).collect() == []


def test_steps_run_in_small_arrow_batches(texts, monkeypatch):
    spark = texts([]).sparkSession
    seen, store = [], ngram_join.stored

    def watched(df, name):
        seen.append(int(spark.conf.get(ngram_join.ARROW_BATCH)))
        return store(df, name)

    monkeypatch.setattr(ngram_join, "stored", watched)
    before = spark.conf.get(ngram_join.ARROW_BATCH)
    rows = [(k, f"a b c d e f {k % 7}") for k in range(30)]
    assert found(jaccard_components(texts(rows), Similarity(4, 85))) == brute(rows, 4, 85)
    assert seen and max(seen) <= ngram_join.BATCH_ROWS
    assert spark.conf.get(ngram_join.ARROW_BATCH) == before


def test_long_texts_are_counted_in_parts(texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "COUNTED_AT_ONCE", 8)
    draw = random.Random(7)
    rows = [(k, changed([f"w{j}" for j in range(60)], k % 3, draw)) for k in range(20)]
    assert found(jaccard_components(texts(rows), Similarity(4, 85))) == brute(rows, 4, 85)
