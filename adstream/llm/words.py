"""Words of a batch of texts and their hashes, by numpy over the UTF-8 bytes.

A fold maps each byte to the byte it counts as; the blank separates words. Bytes
of longer UTF-8 characters count as themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = 0x20
BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def ascii_fold(punctuation: bool = False) -> np.ndarray:
    """A-Z to a-z, tab to carriage return to blank, and punctuation too if asked."""
    fold = np.arange(256, dtype=np.uint8)
    fold[0x09:0x0E] = BLANK
    fold[ord("A") : ord("Z") + 1] += 32
    if punctuation:
        other = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
        fold[other] = BLANK
    return fold


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the base and of its inverse, longer when a longer text comes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK + 4096)
            for name, base in (("up", int(_BASE)), ("down", _inverse(int(_BASE)))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes: first row, bytes, and n + 1 offsets.

    A null text counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        part = offsets[row : stop + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = stop


def find_words(
    data: np.ndarray, offsets: np.ndarray, fold: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and hash of every word, in order."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    found = []
    at = 0
    while at < len(data):
        stop = at + BLOCK
        while stop < len(data) and fold[data[stop]] != BLANK:
            stop += 1
        stop = min(stop, len(data))
        found.append(_block_words(data[at:stop], edge[at : stop + 1], fold, at))
        at = stop
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    start, end, value = (np.concatenate(x) for x in zip(*found, strict=True))
    return start, end, np.searchsorted(offsets, start, side="right") - 1, value


def _block_words(data, edge, fold, at):
    byte = fold[data]
    filled = byte != BLANK
    first, last = filled.copy(), filled.copy()
    first[1:] &= ~filled[:-1] | edge[1:-1]
    last[:-1] &= ~filled[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _POWERS.of(len(byte))
    total = np.zeros(len(byte) + 1, np.uint64)
    np.cumsum((byte.astype(np.uint64) + np.uint64(1)) * up[: len(byte)], out=total[1:])
    value = mixed((total[end] - total[start]) * down[start])
    return start + at, end + at, value


def shingles(value: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``width`` words within a text."""
    n = len(value) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += value[k : k + n] * np.uint64(2 * k * 0x632BE5AB + 0x9E3779B1)
    inside = text[:n] == text[width - 1 :]
    return mixed(total[inside]), text[:n][inside]


def sets(
    texts: pa.Array, width: int, fold: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text.

    A text with words, but fewer than ``width``, has its whole sequence as its one
    shingle; a text without words has none.
    """
    for row, data, offsets in chunks(texts):
        _, _, text, value = find_words(data, offsets, fold)
        made, owner = shingles(value, text, width)
        n = len(offsets) - 1
        bound = np.searchsorted(owner, np.arange(n + 1))
        words = np.searchsorted(text, np.arange(n + 1))
        for k in range(n):
            if bound[k] < bound[k + 1]:
                yield row + k, np.unique(made[bound[k] : bound[k + 1]])
            elif words[k] < words[k + 1]:
                few = value[words[k] : words[k + 1]]
                yield row + k, mixed(shingles(few, np.zeros(len(few), int), len(few))[0] + np.uint64(len(few)))
            else:
                yield row + k, np.empty(0, np.uint64)
