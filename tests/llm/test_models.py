import random

import pytest
from pyspark.sql import functions as F

from adstream.llm import language_id, toxicity

from .conftest import LONG

MILD = "river stone cloud table window garden paper morning evening letter".split()
RUDE = ["gruntface", "snotwort", "blatherskite"]


def sentence(draw, rude):
    words = draw.choices(MILD, k=60)
    for k in range(4 if rude else 0):
        words[draw.randrange(60)] = draw.choice(RUDE)
    return " ".join(words)


@pytest.fixture(scope="module")
def marked(spark):
    draw = random.Random(1)
    rows = [(k, sentence(draw, k % 4 == 0), int(k % 4 == 0)) for k in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows] + [(None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: x for i, _, x in rows}


def test_toxic_words_are_learned(marked):
    docs, labels, truth = marked
    held = toxicity.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, labels, ~held)
    made = toxicity.scored(docs.withColumn("score", F.lit("x")), model)
    assert made.columns == ["doc_id", "text", "score", "toxicity"]
    rows = made.where(held).collect()
    assert sum((r.toxicity >= 0.5) == truth[r.doc_id] for r in rows) / len(rows) > 0.95


def test_odd_texts_are_scored(marked, texts):
    docs, labels, _ = marked
    model = toxicity.fit(docs, labels, F.lit(True))
    odd = texts([(1, None), (2, ""), (None, LONG), (1, None)])
    scores = [r.toxicity for r in toxicity.scored(odd, model).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert toxicity.scored(texts([]), model).collect() == []
    alone = toxicity.fit(docs, labels.where("toxic = 0"), F.lit(True))
    assert toxicity.scored(odd, alone).where("toxicity >= 0.5").count() == 0
    assert toxicity.fit(docs.limit(0), labels, F.lit(True)).weights[0] == 0


SAMPLES = {"aa": "kalu meni toro basi", "bb": "schwer gehen nicht ßtu", "cc": "élan voilà où être"}


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(2)
    rows = [(k, " ".join(draw.choices(SAMPLES[lang].split(), k=40)), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(500, "123 456", "aa"), (501, None, "aa"), (502, "kalu", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, language_id.fit(docs, ~toxicity.held_out(F.col("doc_id"), 3, 1))


def test_held_out_languages(model):
    docs, found = model
    assert found.languages == ["aa", "bb", "cc"]
    rows = language_id.predicted(docs, found).where("doc_id < 500").collect()
    assert sum(r.language == r.lang for r in rows) / len(rows) > 0.97


def test_texts_without_letters(model, texts):
    _, found = model
    odd = texts([(1, None), (2, ""), (3, "12 34!"), (4, LONG), (None, "kalu")])
    made = {r.doc_id: (r.language, r.language_score) for r in language_id.predicted(odd, found).collect()}
    assert made[1] == made[2] == made[3] == ("und", 0.0)
    assert made[4][0] in SAMPLES and 0 <= made[4][1] <= 1 and made[None][0] == "aa"
    assert language_id.predicted(texts([]), found).collect() == []


def test_gradients_are_slopes():
    import numpy as np

    net = language_id.Net(window=12, filters=2, embedding=3)
    made = language_id.Model(net, ["x", "y"])
    made.w = {k: v.astype(np.float64) for k, v in made.w.items()}
    draw = np.random.default_rng(0)
    x, label = draw.integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    slope = made.gradients(x, label)

    def loss():
        return -made.forward(x)[0][np.arange(5), label].mean()

    for name, place in (("out", (1, 0)), ("filter3", (4, 1)), ("bias", (3,)), ("bytes", (x[0, 0], 1))):
        made.w[name][place] += 1e-6
        high = loss()
        made.w[name][place] -= 2e-6
        low = loss()
        made.w[name][place] += 1e-6
        assert abs((high - low) / 2e-6 - slope[name][place]) < 1e-4


def test_nothing_to_learn(texts):
    found = language_id.fit(texts([]), F.lit(True))
    assert [r.language for r in language_id.predicted(texts([(1, "abc")]), found).collect()] == ["und"]


def test_rare_insults_are_learned_at_every_size_and_mix(spark):
    draw = random.Random(6)
    mild = ["".join(draw.choices("abcdefghijklmnoprstuvw", k=draw.randint(3, 9))) for _ in range(400)]
    rude = ["zq" + "".join(draw.choices("aeioubdgkmnprt", k=7)) for _ in range(40)]

    def text(toxic):
        words = draw.choices(mild, k=60)
        for w in rude if toxic else []:
            if draw.random() < 0.05:
                words[draw.randrange(60)] = w
        return " ".join(words)

    for n_toxic, n_ordinary in ((400, 800), (400, 2400)):
        rows = [(k, text(k < n_toxic), int(k < n_toxic)) for k in range(n_toxic + n_ordinary)]
        docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
        labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
        model = toxicity.fit(docs, labels, F.lit(True))
        special = model.toxic[len(model.ordinary) :].decode()
        assert sum(w[:-1] in special or w[1:] in special for w in rude) >= 34
        rows = toxicity.scored(docs, model).join(labels, "doc_id").collect()
        told = [r.toxicity >= 0.5 for r in rows if r.toxic and any(w in r.text for w in rude)]
        assert sum(told) >= 0.9 * len(told)
        assert sum(r.toxicity >= 0.5 for r in rows if not r.toxic) <= 0.03 * n_ordinary


def test_windows_features_equal_plain_python():
    """The score's features, compressed window by window without numpy."""
    import math

    import numpy as np
    import zstandard

    draw = random.Random(8)
    fit = toxicity.Fit()
    ordinary, rude = (" ".join(MILD) * 20).encode(), ("gruntface snotwort " * 20).encode()
    coders = [toxicity._coder(ordinary), toxicity._coder(ordinary + rude)]

    def plain(text):
        folded = "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c for c in text or "")
        data = (" " + folded + " ").encode()
        saved, at = [], 0
        while not saved or at + fit.window - fit.step < len(data):
            part = data[at : at + fit.window]
            sizes = [len(zstandard.ZstdCompressor.compress(c, part)) for c in coders]
            saved.append(sizes[0] - sizes[1])
            at += fit.step
        n = len(saved)
        strong = [sum(s >= k for s in saved) for k in (2, 3, 4)]
        return [1.0, max(saved), sum(saved) / n, *(math.log(1 + s) for s in strong), strong[1] / n, math.log(n)]

    texts = [None, "", "Gruntface\tÉ", *(sentence(draw, k % 2) for k in range(30)), sentence(draw, True) * 40]
    for text in texts:
        got = toxicity._features(text, *(c.compress for c in coders), fit)
        assert np.allclose(got, plain(text)), text


def test_convolution_equals_plain_loops():
    import math

    import numpy as np

    model = language_id.Model(language_id.Net(window=10, filters=3, embedding=2), ["x", "y", "z"])
    w = {k: v.astype(float) for k, v in model.w.items()}
    draw = np.random.default_rng(3)
    x = draw.integers(0, 256, (4, 10)).astype(np.uint8)
    got = model.forward(x)[0]
    for row, found in zip(x, got, strict=True):
        high = []
        for width in model.net.widths:
            for f in range(3):
                sums = []
                for at in range(10 - width + 1):
                    total = 0.0
                    for k in range(width):
                        for e in range(2):
                            total += w["bytes"][row[at + k], e] * w[f"filter{width}"][k * 2 + e, f]
                    sums.append(total)
                high.append(max(sums))
        active = [max(h + b, 0.0) for h, b in zip(high, w["bias"], strict=True)]
        logit = [sum(a * w["out"][k, c] for k, a in enumerate(active)) + w["out_bias"][c] for c in range(3)]
        total = math.log(sum(math.exp(v) for v in logit))
        assert np.allclose(found, [v - total for v in logit], atol=1e-4)


def test_a_letter_is_of_category_l(model, texts):
    _, found = model
    odd = texts([(1, "½ ² 12"), (2, "Ⅷ ①"), (3, "ʰ"), (4, "漢"), (5, "_")])
    got = {r.doc_id: r.language for r in language_id.predicted(odd, found).collect()}
    assert [got[k] == "und" for k in range(1, 6)] == [True, True, False, False, True]
