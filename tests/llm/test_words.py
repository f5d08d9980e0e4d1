import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adstream.llm.words import ascii_fold, find_words, chunks, sets


def plain(text, width):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbB \n\té ", max_size=40), max_size=12))
def test_sets_are_those_of_plain_python(texts):
    made = dict(sets(pa.array(texts, pa.string()), 4, ascii_fold()))
    assert {k: len(s) for k, s in made.items()} == {k: len(plain(t, 4)) for k, t in enumerate(texts)}
    for i, s in made.items():
        for j, t in made.items():
            assert (s.tolist() == t.tolist()) == (plain(texts[i], 4) == plain(texts[j], 4))


def test_words_do_not_depend_on_where_a_text_lies():
    text = "Alpha beta  gamma"
    alone = [find_words(d, o, ascii_fold())[3].tolist() for _, d, o in chunks(pa.array([text]))]
    after = [find_words(d, o, ascii_fold())[3].tolist() for _, d, o in chunks(pa.array(["é" * 9, text]))]
    assert after[0][1:] == alone[0]


def test_long_texts_are_cut_between_words():
    text = "word " * 500_000 + "x" * 3_000_000
    (row, data, offsets), = chunks(pa.array([text]))
    start, end, _, value = find_words(data, offsets, ascii_fold())
    assert len(start) == 500_001 and len(set(value.tolist())) == 2 and end[-1] == len(text)
