"""Language ID by a convolutional network over bytes, in numpy.

Bytes are embedded; filters of several widths slide over fixed-length windows; each
filter's maximum over the window, rectified, goes to a softmax over the languages.
It is trained by Adam on windows of a bounded sample of labelled documents, and
applied to every window of every text: a document's language is the one with the
greatest mean log-probability over its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.tables import hashed_sample, unused

LETTER = regex.compile(r"\p{L}")
BATCH = 512


@dataclass(frozen=True)
class Net:
    """Shape of the network, bound of the sample, and the training."""

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 8
    embedding: int = 8
    documents: int = 2000
    windows: int = 8000
    epochs: int = 12
    rate: float = 0.01
    seed: int = 7


class Model:
    """Weights by name; ``languages`` are the classes in order."""

    def __init__(self, net: Net, languages: list[str]):
        draw = np.random.default_rng(net.seed)
        self.net, self.languages = net, languages
        self.w = {"bytes": draw.normal(0, 0.5, (256, net.embedding))}
        for width in net.widths:
            size = width * net.embedding
            self.w[f"filter{width}"] = draw.normal(0, size**-0.5, (size, net.filters))
        total = net.filters * len(net.widths)
        self.w["bias"] = np.zeros(total)
        self.w["out"] = draw.normal(0, total**-0.5, (total, len(languages)))
        self.w["out_bias"] = np.zeros(len(languages))
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, dict]:
        """Log-probabilities of each window, and what training needs."""
        n, length = x.shape
        embedded = self.w["bytes"][x]
        pooled, kept = [], {"x": x}
        for width in self.net.widths:
            places = length - width + 1
            view = np.lib.stride_tricks.as_strided(
                embedded,
                (n, places, width * self.net.embedding),
                (embedded.strides[0], embedded.strides[1], embedded.strides[2]),
            )
            made = np.ascontiguousarray(view).reshape(n * places, -1) @ self.w[f"filter{width}"]
            made = made.reshape(n, places, -1)
            kept[width] = (view, made)
            pooled.append(made.max(axis=1))
        high = np.concatenate(pooled, axis=1) + self.w["bias"]
        active = np.maximum(high, 0)
        logit = active @ self.w["out"] + self.w["out_bias"]
        logit -= logit.max(axis=1, keepdims=True)
        kept |= {"high": high, "active": active}
        return logit - np.log(np.exp(logit).sum(axis=1, keepdims=True)), kept

    def gradients(self, x: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        found, kept = self.forward(x)
        n = len(x)
        slope = np.exp(found)
        slope[np.arange(n), label] -= 1
        slope /= n
        made = {"out": kept["active"].T @ slope, "out_bias": slope.sum(0)}
        back = (slope @ self.w["out"].T) * (kept["high"] > 0)
        made["bias"] = back.sum(0)
        into = np.zeros((*x.shape, self.net.embedding), np.float32)
        for k, width in enumerate(self.net.widths):
            view, conv = kept[width]
            part = back[:, k * self.net.filters : (k + 1) * self.net.filters]
            place = conv.argmax(axis=1)
            row = np.arange(n)[:, None]
            seen = view[row, place]
            made[f"filter{width}"] = np.einsum("nfs,nf->sf", seen, part)
            given = (part[:, :, None] * self.w[f"filter{width}"].T[None]).reshape(
                n, self.net.filters, width, self.net.embedding
            )
            for step in range(width):
                np.add.at(into, (row, place + step), given[:, :, step])
        made["bytes"] = np.zeros_like(self.w["bytes"])
        np.add.at(made["bytes"], x.ravel(), into.reshape(-1, self.net.embedding))
        return made

    def train(self, x: np.ndarray, label: np.ndarray) -> None:
        draw = np.random.default_rng(self.net.seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(self.net.epochs):
            order = draw.permutation(len(x))
            for at in range(0, len(x), 128):
                step += 1
                pick = order[at : at + 128]
                for k, g in self.gradients(x[pick], label[pick]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    scaled = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.w[k] -= np.float32(self.net.rate) * scaled.astype(np.float32)


def windows(text: str, length: int) -> np.ndarray:
    """All of a text's bytes as rows of one length, the last filled up with zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    full = np.zeros(max(1, -(-len(data) // length)) * length, np.uint8)
    full[: len(data)] = data
    return full.reshape(-1, length)


def fit(docs: DataFrame, learn: Column, net: Net = Net()) -> Model:
    """A model of the documents for which ``learn`` holds, by their ``lang``.

    Takes at most ``net.documents`` documents, in the order of a hash of their ids, and
    ``net.windows`` of their windows. Texts without letters and null values teach
    nothing. Without documents no language is learned.
    """
    known = docs.where(learn & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    rows = hashed_sample(known, net.documents, "doc_id", "lang", "text")
    rows = rows.where(F.col("text").rlike(r"\p{L}")).toPandas()
    languages = sorted(rows["lang"].unique())
    model = Model(net, languages)
    if len(languages):
        cut = [windows(t, net.window) for t in rows["text"]]
        x = np.concatenate(cut)
        label = np.repeat(rows["lang"].map(languages.index).to_numpy(), [len(c) for c in cut])
        pick = np.random.default_rng(net.seed).permutation(len(x))[: net.windows]
        model.train(x[pick], label[pick])
    return model


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``language`` and ``language_score``, its probability, behind.

    Where a column of the documents has one of these names, the new one has an
    underscore more. A letter is what Unicode puts into category L.
    A null text, or one without letters, is ``und`` with score 0, and so is every text
    if no language was learned. Every row keeps its row and columns; repeated rows get
    the same. No rows give no rows.
    """

    @F.pandas_udf("language string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        named, scores = ["und"] * len(texts), [0.0] * len(texts)
        asked = [k for k, t in enumerate(texts) if t and model.languages and LETTER.search(t)]
        cut = (windows(texts.iloc[k], model.net.window) for k in asked)
        for k, total, count in _summed(cut, asked, model):
            share = np.exp(total / count - (total / count).max())
            best = int(share.argmax())
            named[k], scores[k] = model.languages[best], float(share[best] / share.sum())
        return pd.DataFrame({"language": named, "score": scores})

    both = unused("_predicted", docs)
    made = docs.withColumn(both, predict(F.col("text").cast("string")))
    return made.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(f"{both}.language").alias(unused("language", docs)),
        F.col(f"{both}.score").alias(unused("language_score", docs)),
    )


def _summed(cut, asked, model: Model):
    """Summed log-probabilities and number of windows of each text, batch by batch."""
    waiting, owners = [], []

    def flush():
        x = np.concatenate(waiting)
        found = np.concatenate([model.forward(x[k : k + BATCH])[0] for k in range(0, len(x), BATCH)])
        at = np.cumsum([0] + [len(w) for w in waiting])[:-1]
        return zip(owners, np.add.reduceat(found, at), [len(w) for w in waiting], strict=True)

    size = 0
    for k, rows in zip(asked, cut, strict=True):
        waiting.append(rows)
        owners.append(k)
        size += len(rows)
        if size >= 4 * BATCH:
            yield from flush()
            waiting, owners, size = [], [], 0
    if waiting:
        yield from flush()
