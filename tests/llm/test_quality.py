import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adstream.llm import quality, toxicity
from adstream.llm.boosted_trees import Boosting, learned
from adstream.llm.document_statistics import KINDS, NAMES, statistics

from .conftest import LONG

WORDS = "river stone cloud table window garden paper morning evening letter".split()


def document(draw, good):
    words = draw.choices(WORDS, k=60) if good else draw.choices(WORDS[:2], k=60)
    return " ".join(w if good else w + "###" for w in words) + "."


@pytest.fixture(scope="module")
def marked(spark):
    draw = random.Random(3)
    rows = [(k, document(draw, k % 5 > 0), int(k % 5 > 0)) for k in range(300)]
    docs = spark.createDataFrame([(i, t, 7.0) for i, t, _ in rows], "doc_id long, text string, x double")
    odd = [(None, 1, 0), (2, None, 0), (3, 0, 0), (3, 1, 0), (999, 1, 0)]
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + odd, "doc_id long, quality int, toxic int")
    return docs, labels, {i: q for i, _, q in rows}


def test_held_out_documents_are_told_apart(marked):
    docs, labels, truth = marked
    held = toxicity.held_out(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, labels, ~held)
    made = quality.scored(docs.withColumn("score", F.lit("own")), model)
    assert made.columns == ["doc_id", "text", "x", "score", "quality_score"]
    rows = made.where(held).collect()
    assert len(rows) > 40
    assert sum((r.quality_score >= 0.5) == truth[r.doc_id] for r in rows) / len(rows) > 0.95


def test_odd_texts_and_tables(marked, texts):
    docs, labels, _ = marked
    model = quality.fit(docs, labels, F.lit(True))
    rows = [(1, None), (2, ""), (3, " \n"), (4, LONG), (4, LONG), (None, "½ ² 12"), (5, "\U0001f600" * 9)]
    got = quality.scored(texts(rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r.quality_score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.quality_score)
    assert by_id[1] == by_id[2] and len(by_id[4]) == 1
    assert quality.scored(texts([]), model).collect() == []
    clashing = quality.scored(docs.limit(1).withColumn("quality_score", F.lit(7)), model)
    assert clashing.columns[-2:] == ["quality_score", "quality_score_"] and clashing.first()["quality_score"] == 7


def test_labels_of_one_kind_or_none_give_their_share(marked):
    docs, labels, _ = marked
    for kept, score in (("quality = 1", 0.999), ("quality = 0", 0.001), ("false", 0.5)):
        model = quality.fit(docs, labels.where(kept), F.lit(True))
        got = {round(r.quality_score, 9) for r in quality.scored(docs.limit(3), model).collect()}
        assert got == {score}


def test_sample_is_bounded_and_weighed(marked):
    docs, labels, _ = marked
    model = quality.fit(docs, labels, F.lit(True), quality.Fit(good=10, bad=10))
    assert np.isclose(1 / (1 + np.exp(-model.base)), 240 / 300, atol=0.01)


def plain(text):
    """Some of the statistics, character by character."""
    raw = (text or "").encode()
    share = {k: sum(b in set(v) for b in raw) / max(len(raw), 1) for k, v in BYTES.items()}
    folded = raw.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    words = folded.split()
    lines = [x for x in raw.split(b"\n") if x]
    runs = list(zip(words, words[1:], words[2:], strict=False))
    some = max(len(words), 1)
    return share | {
        "words": np.log1p(len(words)),
        "word_mean": sum(map(len, words)) / some,
        "word_longest": np.log1p(max(map(len, words), default=0)),
        "words_distinct": len(set(words)) / some,
        "word_most": max(Counter(words).values(), default=0) / some,
        "runs_again": 1 - len(set(runs)) / max(len(runs), 1),
        "lines": np.log1p(len(lines)),
        "lines_again": 1 - len(set(lines)) / max(len(lines), 1),
        "line_stop": sum(x[-1:] in (b".", b"!", b"?") for x in lines) / max(len(lines), 1),
    }


BYTES = {"upper": range(65, 91), "digit": range(48, 58), "blank": [9, 10, 11, 12, 13, 32], "newline": [10]}


def test_statistics_equal_plain_python():
    draw = random.Random(5)
    alphabet = "abcABC  \n\n.!?#é漢9\t"
    rows = ["".join(draw.choices(alphabet, k=draw.randrange(300))) for _ in range(200)]
    rows += [None, "", "\n", "a", LONG, LONG + "\n" + LONG]
    made = statistics(pa.array(rows))
    assert made.shape == (len(rows), len(NAMES)) and set(BYTES) < set(KINDS)
    for text, row in zip(rows, made, strict=True):
        for name, value in plain(text).items():
            assert np.isclose(row[NAMES.index(name)], value, rtol=1e-5, atol=1e-6), name


def descended(model, row):
    total = model.base
    for node in model.roots:
        while model.left[node] != node:
            low = row[model.feature[node]] <= model.edge[node]
            node = model.left[node] if low else model.right[node]
        total += model.value[node]
    return 1 / (1 + np.exp(-total))


def test_flat_arrays_give_what_a_walk_down_each_tree_gives():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(600, 5))
    x[:, 4] = 1.0
    label = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = learned(x[:500], label[:500], np.ones(500), Boosting(trees=30))
    got = model.score(x, rows=64)
    assert np.allclose(got, [descended(model, row) for row in x])
    assert ((got >= 0.5) == label)[500:].mean() > 0.9
    assert (model.left >= np.arange(len(model.left))).all()


def test_a_split_is_the_best_of_all_cuts():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 6, (80, 3)).astype(float)
    label = (x[:, 2] > 2).astype(float)
    how = Boosting(trees=1, depth=1, ridge=1.0, least=1.0, gain=0.0)
    model = learned(x, label, np.ones(80), how)
    share = label.mean()

    def gain(feature, cut):
        low = x[:, feature] <= cut
        made = 0
        for side in (low, ~low):
            made += (share - label[side]).sum() ** 2 / (side.sum() * share * (1 - share) + 1)
        return made

    best = max((gain(f, c), f, c) for f in range(3) for c in range(5))
    assert (model.feature[model.roots[0]], model.edge[model.roots[0]]) == best[1:]
