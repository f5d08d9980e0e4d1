import random

from adstream.llm.segment_dedup import Repeats, repeated_spans

from .conftest import LONG

PASSAGE = "One two three four five six. Seven eight nine ten eleven twelve. Thirteen fourteen fifteen sixteen."


def spans(df):
    return sorted((r.doc_id, r.start, r.end, r.kept_doc_id, r.kept_start) for r in df.collect())


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeghilmnorstué", k=rng.randint(2, 9))) for _ in range(n))


def test_later_copies_go_with_their_offsets(texts):
    late = "É first line.\nAnd now: this. " + PASSAGE.upper() + " The end."
    rows = [(2, "Intro here. " + PASSAGE), (5, late), (3, "short line"), (4, "short line"), (6, None), (7, ""), (None, PASSAGE), (2, "Intro here. " + PASSAGE)]
    at = late.index("ONE TWO")
    # Its first sentence is a unit with the words before it, so the second is the first whole one.
    assert spans(repeated_spans(texts(rows), Repeats(words=10))) == [(5, at, at + len(PASSAGE), 2, 41)]


def test_repeats_within_a_text_and_few_words(texts):
    rows = [(1, PASSAGE + "\n" + PASSAGE), (2, "a b.\na b.\na b.")]
    assert spans(repeated_spans(texts(rows), Repeats(words=10))) == [
        (1, len(PASSAGE) + 1, 2 * len(PASSAGE) + 1, 1, 0)
    ]


def test_later_whole_lines_go_however_few_their_words(texts):
    line = "all twelve words of this one line stand in another document too"
    rows = [(9, line), (3, "before it.\n" + line.title() + "\nand after it."), (4, "four words\nonly here")]
    assert spans(repeated_spans(texts([*rows, (5, "four words\nand there")]))) == [(9, 0, len(line), 3, 11)]


def test_passages_that_begin_and_end_within_sentences(texts):
    words = prose(55, 1).split()
    passage = " ".join(words[:9]) + ", " + " ".join(words[9:20]) + ". " + " ".join(words[20:45]) + "! " + " ".join(words[45:])
    one, other = f"Here it is {passage} and more.", f"Elsewhere. Say {passage} but other."
    assert spans(repeated_spans(texts([(1, one), (2, other)]))) == [(2, 15, 15 + len(passage), 1, one.index(words[9 + 11]))]


def test_passages_within_one_sentence(texts):
    """Where a cut lies within four words of a passage's end, those words may stay."""
    rows, passages = [], {}
    for seed in range(0, 400, 8):
        passage = prose(55, seed)
        passages[seed + 1] = passage.split()
        rows.append((seed, f"{prose(70, seed + 1)} {passage} {prose(40, seed + 2)}."))
        rows.append((seed + 1, f"{prose(33, seed + 3)} {passage} {prose(60, seed + 4)}"))
    late = dict(rows)
    found = repeated_spans(texts(rows)).collect()
    assert sorted(r.doc_id for r in found) == sorted(passages)
    for r in found:
        words = late[r.doc_id][r.start : r.end].split()
        whole = passages[r.doc_id]
        assert 47 <= len(words) == r.words and " ".join(words) in " ".join(whole)


def test_texts_of_one_document_number_are_apart(texts):
    line = "twelve words or more that are held twice here in two texts."
    rows = [(1, line), (7, "Some other text before.\n" + line), (7, line)]
    assert sorted((r.doc_id, r.start, r.words) for r in repeated_spans(texts(rows)).collect()) == [(7, 0, 12), (7, 24, 12)]


def test_one_row_many_times(spark, texts):
    many = texts([(1, PASSAGE), (2, PASSAGE)]).crossJoin(spark.range(5000)).drop("id")
    assert spans(repeated_spans(many)) == [(2, 0, len(PASSAGE), 1, 0)]


def test_long_texts_and_no_documents(texts):
    assert repeated_spans(texts([])).collect() == []
    # The words of the long text come again after 977 * 31 of them.
    again = len(" ".join(LONG.split()[: 977 * 31])) + 1
    found = [s[:4] for s in spans(repeated_spans(texts([(1, LONG), (2, LONG)])))]
    assert found == [(1, again, len(LONG), 1), (2, 0, len(LONG), 1)]
