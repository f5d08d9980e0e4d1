"""Toxicity by compression distance: two Zstandard dictionaries, one text window at a time.

Both dictionaries hold segments common in ordinary text. The toxic one also holds
segments that toxic documents have far more often (beyond chance by a likelihood
ratio, and by the ratio of the shares), picked greedily so that each adds strings
the others lack. A window that the toxic
dictionary shortens more than the ordinary one speaks toxic language. How many
windows of a document do so, how strongly, and in what share is calibrated to a
score by logistic regression, on documents that the dictionaries were not made of.

The models are fitted on a bounded sample of labelled documents (``Fit``); scores
use windows over the whole of every text. Dictionaries of the library's own trainer
were tried first: on held-out documents their windows ranked toxic documents little
better than chance, as frequent ordinary strings crowd out the telling ones.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.tables import hashed_sample, unused
from adstream.llm.words import ascii_fold

GRAM = 5
SEGMENT = 32
FEATURES = 8


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample and of the dictionaries, and the windows.

    A string tells if its share of the toxic documents is ``times`` its share of the
    ordinary ones, and if by chance not even one of all strings would be as frequent
    in toxic documents, at a probability of ``chance``. Neither asks for more where
    there are more documents or another mix. A string counts where
    it has ``fresh`` of the ratio of what overlaps it, and a segment is picked if so
    much of its worth is new: strings come without their neighbours. The calibration sees each document by
    dictionaries of the other ``folds``; a toxic one weighs as ``weight`` ordinary
    ones, as a missed one costs more than a lost one.
    """

    toxic: int = 2000
    ordinary: int = 4000
    dictionary: int = 4096
    window: int = 96
    step: int = 48
    chance: float = 0.01
    times: float = 16.0
    fresh: float = 0.5
    folds: int = 3
    weight: float = 2.0
    common: float = 0.02


@dataclass
class Model:
    """Dictionaries, and the scaled weights of the calibration."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    fit: Fit = field(default_factory=Fit)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id falls into the fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _folded(text: str | None) -> bytes:
    """Lower case (A-Z), with one blank at each end so that words have edges."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return b" " + ascii_fold()[raw].tobytes() + b" "


def _grams(data: bytes) -> np.ndarray:
    byte = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(len(byte) - GRAM + 1, 0)
    made = np.zeros(n, np.uint64)
    for k in range(GRAM):
        made = (made << np.uint64(8)) | byte[k : k + n]
    return made


def _documents_with(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    each = [np.unique(_grams(t)) for t in texts]
    return np.unique(np.concatenate([*each, np.empty(0, np.uint64)]), return_counts=True)


def _telling(toxic, ordinary, n_toxic: int, n_ordinary: int, how: Fit, tried: int = 0):
    """Grams that tell (see ``Fit``), with the likelihood ratio, of ``tried`` or all given."""
    gram, a = toxic
    at = np.searchsorted(ordinary[0], gram)
    at[at == len(ordinary[0])] = 0
    b = np.where(ordinary[0][at] == gram, ordinary[1][at], 0) if len(ordinary[0]) else 0 * a
    expected = (a + b) * (n_toxic / (n_toxic + n_ordinary))
    ratio = 2 * (
        a * np.log(a / expected) + b * np.log(np.maximum(b, 0.5) / np.maximum(a + b - expected, 1e-9))
    )
    # exp(-x / 2) bounds the chance of a ratio of x or more; it is shared by all grams.
    tells = ratio >= 2 * np.log(max(tried, len(gram), 1) / how.chance)
    tells &= a / n_toxic >= how.times * np.maximum(b, 0.5) / n_ordinary
    return gram[tells], ratio[tells]


def _strongest(texts: list[bytes], gram: np.ndarray, ratio: np.ndarray, how: Fit):
    """Documents with each gram where none that overlaps it has much more of a ratio.

    Else the letters around a telling string tell too, as they are its neighbours.
    """
    each = []
    for text in texts if len(gram) else []:
        grams = _grams(text)
        at = np.searchsorted(gram, grams)
        at[at == len(gram)] = 0
        here = np.where(gram[at] == grams, ratio[at], 0)
        wide = np.concatenate([np.zeros(GRAM - 1), here, np.zeros(GRAM - 1)])
        most = np.max([wide[k : k + len(here)] for k in range(2 * GRAM - 1)], axis=0)
        each.append(np.unique(grams[(here > 0) & (here >= how.fresh * most)]))
    return np.unique(np.concatenate([*each, np.empty(0, np.uint64)]), return_counts=True)


def _cover(texts: list[bytes], gram: np.ndarray, worth: np.ndarray, size: int, fresh: float = 0.0) -> bytes:
    """Segments of the texts that cover the worthiest grams, the best at the end.

    ``fresh`` is the share of a segment's worth that none before it may have covered.
    """
    found: set[bytes] = set()
    for text in texts if len(gram) else []:
        grams = _grams(text)
        at = np.searchsorted(gram, grams)
        at[at == len(gram)] = 0
        inside = np.concatenate([[0], (gram[at] == grams).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(inside))
        for first, last in zip(edges[::2], edges[1::2], strict=True):
            found.add(text[first : min(last, first + SEGMENT - GRAM + 1) + GRAM - 1])
    left = dict(zip(gram.tolist(), worth.tolist(), strict=True))

    def value(segment: bytes) -> float:
        return sum(left[g] for g in set(_grams(segment).tolist())) / len(segment) ** 0.5

    heap = [(-value(segment), segment) for segment in sorted(found)]
    whole = {segment: -less for less, segment in heap}
    heapq.heapify(heap)
    picked, total = [], 0
    while heap and total < size:
        _, segment = heapq.heappop(heap)
        now = value(segment)
        if now <= max(1e-9, fresh * whole[segment]):
            continue
        if heap and -now > heap[0][0]:
            heapq.heappush(heap, (-now, segment))
            continue
        picked.append(segment)
        total += len(segment)
        left.update((g, 0.0) for g in _grams(segment).tolist())
    return b"".join(reversed(picked))


def _coder(dictionary: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(
        compression_level=3, min_match=3, strategy=zstandard.STRATEGY_GREEDY, search_log=6,
        write_content_size=False,
    )
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=held)


def _features(text: str | None, ordinary, toxic, fit: Fit) -> list[float]:
    """Of the bytes that the toxic dictionary saves, window by window."""
    data = _folded(text)
    last = max(1, len(data) - fit.window + fit.step)
    saved = np.array([
        len(ordinary(data[k : k + fit.window])) - len(toxic(data[k : k + fit.window]))
        for k in range(0, last, fit.step)
    ], float)
    strong = [np.count_nonzero(saved >= k) for k in (2, 3, 4)]
    return [1.0, saved.max(), saved.mean(), *np.log1p(strong), strong[1] / len(saved), np.log(len(saved))]


def _calibrated(features: np.ndarray, label: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression, for features as they are.

    ``share`` is how much each document weighs.
    """
    middle, scale = features.mean(0), features.std(0) + 1e-9
    middle[0], scale[0] = 0, 1
    x = (features - middle) / scale
    weight = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (share * (p - label)) / len(label) + 1e-3 * weight
        curve = (x * (share * p * (1 - p))[:, None]).T @ x / len(label) + 1e-3 * np.eye(len(weight))
        weight -= np.linalg.solve(curve, slope)
    weight /= scale
    weight[0] -= (weight * middle)[1:].sum()
    return weight


def _without(every, part) -> tuple[np.ndarray, np.ndarray]:
    """The counts of ``every`` without those of a part of its documents."""
    count = every[1].copy()
    count[np.searchsorted(every[0], part[0])] -= part[1]
    return every[0][count > 0], count[count > 0]


def _learned(toxic: list[str], ordinary: list[str], how: Fit) -> Model:
    """A model of the texts of both kinds, of which there are some."""
    # Equal texts count once and share a fold, so none is calibrated by its copy.
    sides = [[_folded(t) for t in side] for side in (toxic, ordinary)]
    once = [sorted(set(side)) for side in sides]
    parts = [[[t for t in side if zlib.crc32(t) % how.folds == k] for k in range(how.folds)] for side in once]
    count = [_documents_with(side) for side in once]
    often = count[1][1] >= how.common * len(once[1])
    base = _cover(once[1], count[1][0][often], count[1][1][often].astype(float), how.dictionary)

    def telling(gone: int | None = None) -> bytes:
        left, n, texts = count, [len(side) for side in once], once[0]
        if gone is not None and all(len(p[gone]) < len(side) for p, side in zip(parts, once, strict=True)):
            left = [_without(c, _documents_with(p[gone])) for c, p in zip(count, parts, strict=True)]
            n = [len(side) - len(p[gone]) for p, side in zip(parts, once, strict=True)]
            texts = [t for k, p in enumerate(parts[0]) if k != gone for t in p]
        gram, ratio = _telling(*left, *n, how)
        # Again, with each occurrence counted for its strongest strings only.
        gram, ratio = _telling(_strongest(texts, gram, ratio, how), left[1], *n, how, len(left[0][0]))
        return base + _cover(texts, gram, ratio, how.dictionary, how.fresh)

    model = Model(base, telling(), np.zeros(FEATURES), how)
    features, label = [], []
    for k in range(how.folds):
        coders = _coder(base).compress, _coder(telling(k)).compress
        for texts, folded, kind in zip((toxic, ordinary), sides, (1.0, 0.0), strict=True):
            here = [_features(t, *coders, how) for t, f in zip(texts, folded, strict=True) if zlib.crc32(f) % how.folds == k]
            features += here
            label += [kind] * len(here)
    label = np.array(label)
    model.weights = _calibrated(np.array(features), label, 1 + (how.weight - 1) * label)
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column, how: Fit = Fit()) -> Model:
    """A model of the labelled documents for which ``learn`` holds.

    Takes at most ``how.toxic`` and ``how.ordinary`` documents, in the order of a hash
    of their ids. Null texts, ids and labels teach nothing. Without documents of both
    kinds every score is the share of toxic ones (one half without any).
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    texts = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text")
    picked = known.where(learn)
    marked, plain = (
        hashed_sample(picked.where(F.col("_toxic") == label), bound, "doc_id")
        for label, bound in ((1, how.toxic), (0, how.ordinary))
    )
    # No more ids than the two bounds.
    ids = F.broadcast(marked.unionByName(plain))
    rows = texts.join(ids, "doc_id").groupBy("doc_id", "_toxic").agg(F.min("text").alias("text"))
    rows = sorted(rows.toPandas().itertuples(index=False), key=lambda r: r.doc_id)
    sides = [[r for r in rows if r[1] == label] for label in (1, 0)]
    toxic, ordinary = ([r.text for r in side] for side in sides)
    if toxic and ordinary:
        return _learned(toxic, ordinary, how)
    share = 0.5 if not toxic and not ordinary else 0.001 if not toxic else 0.999
    weights = np.zeros(FEATURES)
    weights[0] = np.log(share / (1 - share))
    return Model(b"", b"", weights, how)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a column ``toxicity`` between 0 and 1 behind their own.

    Where they have a column of that name, the new one has an underscore more.

    A null or empty text is scored as one empty window. Every row keeps its row and its
    columns; repeated rows score alike. No rows give no rows.
    """

    @F.pandas_udf("double")
    def toxicity(texts):
        coders = _coder(model.ordinary).compress, _coder(model.toxic).compress
        made = np.array([_features(t, *coders, model.fit) for t in texts]).reshape(-1, FEATURES)
        return pd.Series(1 / (1 + np.exp(-np.clip(made @ model.weights, -30, 30))))

    return docs.withColumn(unused("toxicity", docs), toxicity(F.col("text").cast("string")))
