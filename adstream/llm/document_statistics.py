"""Statistics of whole documents, by numpy over batches of texts.

Nothing here depends on a language: shares of kinds of characters, shapes of words,
and how often words, runs of three words and lines come again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from adstream.llm.words import BLANK, BLOCK, ascii_fold, chunks, find_words, shingles

LETTERS = [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]
KINDS = {
    "upper": range(ord("A"), ord("Z") + 1),
    "lower": range(ord("a"), ord("z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "blank": [*range(0x09, 0x0E), BLANK],
    "newline": [0x0A],
    "stop": map(ord, ".!?"),
    "pause": map(ord, ",;:"),
    "symbol": map(ord, '"#$%&()*+-/<=>@[\\]^_`{|}~'),
    "control": [*range(0x09), *range(0x0E, BLANK), 0x7F],
    "other": range(0x80, 0x100),
}
KIND = np.array([[b in set(v) for b in range(256)] for v in map(list, KINDS.values())], float).T
NAMES = [
    "bytes", *KINDS, "entropy",
    "words", "word_mean", "word_spread", "word_longest", "word_symbol", "word_upper",
    "word_capital", "word_single", "words_distinct", "word_most", "runs_again",
    "lines", "line_mean", "line_spread", "lines_again", "line_stop", "line_words",
]
_UPPER, _LETTER, _SIGN, _STOP = (np.zeros(256, bool) for _ in range(4))
_UPPER[list(range(ord("A"), ord("Z") + 1))] = True
_LETTER[[*LETTERS, *range(0x80, 0x100)]] = True
_SIGN[KIND[:, list(KINDS).index("symbol")] > 0] = True
_SIGN[ord("!")] = True
_STOP[[ord(c) for c in ".!?"]] = True
_LINES = np.arange(256, dtype=np.uint8)
_LINES[BLANK], _LINES[0x0A] = 0x01, BLANK


def _bytes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each byte is in each text, a block at a time."""
    n = len(offsets) - 1
    total = np.zeros(n * 256, np.int64)
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK]
        text = np.searchsorted(offsets, np.arange(at, at + len(part)), side="right") - 1 if n > 1 else 0
        total += np.bincount(text * 256 + part, minlength=n * 256)
    return total.reshape(n, 256)


def _again(value: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and how often its commonest is there."""
    key = np.sort((text.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
    owner = (key[first] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, np.diff(np.append(first, len(key))))
    return np.bincount(owner, minlength=n).astype(float), most


def _spread(size: np.ndarray, text: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, at_least = len(count), np.maximum(count, 1)
    mean = np.bincount(text, size, n) / at_least
    return mean, np.sqrt(np.maximum(np.bincount(text, size * size, n) / at_least - mean**2, 0))


def _chunk(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    found = _bytes(data, offsets)
    size = found.sum(axis=1)
    share = found / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.maximum(share, 1e-300))).sum(axis=1)
    rows = [np.log1p(size), *(share @ KIND).T, entropy]

    start, end, text, value = find_words(data, offsets, ascii_fold())
    words = np.bincount(text, minlength=n).astype(float)
    some = np.maximum(words, 1)
    length = (end - start).astype(float)
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    first, last = data[start], data[end - 1]
    capital = _UPPER[first]
    shouted = capital & _UPPER[data[np.minimum(start + 1, end - 1)]] & (length > 1)
    lone = (length == 1) & ~_LETTER[first]
    distinct, most = _again(value, text, n)
    run, owner = shingles(value, text, 3)
    runs = np.bincount(owner, minlength=n).astype(float)
    runs_distinct, _ = _again(run, owner, n)
    rows += [np.log1p(words), *_spread(length, text, words), np.log1p(longest)]
    rows += [np.bincount(text, mark, n) / some for mark in (_SIGN[last], shouted, capital, lone)]
    rows += [distinct / some, most / some, 1 - runs_distinct / np.maximum(runs, 1)]

    start, end, line, value = find_words(data, offsets, _LINES)
    lines = np.bincount(line, minlength=n).astype(float)
    some = np.maximum(lines, 1)
    distinct, _ = _again(value, line, n)
    rows += [np.log1p(lines), *(np.log1p(x) for x in _spread((end - start).astype(float), line, lines))]
    rows += [1 - distinct / some, np.bincount(line, _STOP[data[end - 1]], n) / some, np.log1p(words / some)]
    return np.array(rows).T


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of NAMES for each text; a null text counts as empty."""
    made = [np.empty((0, len(NAMES)))]
    made += [_chunk(data, offsets) for _, data, offsets in chunks(texts)]
    return np.concatenate(made).astype(np.float32).astype(float)
