from itertools import combinations

from adstream.llm.decontamination import WINDOW, contaminated, decontaminated, masks

ITEM = "the quick brown fox jumps over a lazy dog while seven wise owls watch the old barn door"
WORDS = ITEM.split()


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, seed int")


def swapped(*places):
    return " ".join("zzz" if k in places else w for k, w in enumerate(WORDS))


def test_masks_survive_any_two_substitutions():
    for gone in combinations(range(WINDOW), 2):
        assert sum(set(gone) <= set(m) for m in masks()) == 1


def test_substitutions_case_and_punctuation(spark, texts):
    far = [k for k in range(len(WORDS)) if k % 5 == 0]
    docs = texts([
        (1, "intro " + ITEM.upper().replace(" ", ", ") + " outro"),
        (2, "x y " + swapped(4, 10)),
        (3, swapped(*[k for k in range(len(WORDS)) if k % 4 == 0])),
        (4, None), (5, ""), (None, ITEM), (1, "clean text of another kind"), (6, " ".join(WORDS[:10])),
        (7, swapped(*far)), (8, ITEM), (8, ITEM),
    ])
    made = contaminated(docs, bench(spark, [(9, ITEM), (None, ITEM), (10, None), (11, ""), (9, ITEM)]))
    hit = sorted(((r.doc_id, r.item_id) for r in made.collect()), key=str)
    brute = sorted(
        ((i, 9) for i, t in ((r.doc_id, r.text) for r in docs.collect()) if leaks(t)), key=str
    )
    assert hit == brute and {1, 2, None, 8} <= {i for i, _ in hit} and 3 not in dict(hit)
    kept = decontaminated(docs, bench(spark, [(9, ITEM)]))
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {
        (r.doc_id, r.text) for r in docs.collect() if not leaks(r.text)
    }


def leaks(text):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return any(
        sum(a == b for a, b in zip(words[i : i + 13], WORDS[j : j + 13], strict=True)) >= 11
        for i in range(len(words) - 12)
        for j in range(len(WORDS) - 12)
    )


def test_short_items_must_occur_whole(spark, texts):
    docs = texts([(1, "so alpha beta gamma delta epsilon zeta eta theta it goes"), (2, "alpha beta gamma"), (3, "alpha beta gamma delta epsilon zzz eta theta")])
    items = bench(spark, [(1, "Alpha beta gamma delta epsilon zeta eta theta"), (2, "alpha beta gamma")])
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()] == [(1, 1)]


def test_empty_tables(spark, texts):
    none, some = bench(spark, []), texts([(1, ITEM)])
    assert contaminated(some, none).collect() == []
    assert contaminated(texts([]), bench(spark, [(1, ITEM)])).collect() == []
    assert decontaminated(some, none).count() == 1
