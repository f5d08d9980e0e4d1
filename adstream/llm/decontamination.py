"""Benchmark decontamination by spaced-seed hashing.

A mask over a window of tokens ignores some positions, so hashes agree although
tokens there differ. The masks are the shifts of a perfect difference set: any two
positions of the window are ignored together by one of them, so a window with up
to two substituted tokens always agrees with the benchmark under some mask. Hits
are verified by comparing the windows around them token by token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.tables import membership, passes, set_apart, split_join, stored, unused
from adstream.llm.words import ascii_fold, chunks, find_words, mixed

# Positions that the first mask ignores. Their differences modulo 13
# are 1 to 12, once each.
IGNORED = (0, 1, 3, 9)
WINDOW = 13


@dataclass(frozen=True)
class Overlap:
    """A window of 13 tokens with at most this many substitutions.

    An item shorter than the window counts where all of it occurs unchanged; one
    shorter than ``least`` tokens is too common a phrase and is found nowhere.
    """

    substitutions: int = 2
    least: int = 8


def masks() -> list[list[int]]:
    """Ignored positions of each mask."""
    return [sorted((k + shift) % WINDOW for k in IGNORED) for shift in range(WINDOW)]


def _weights(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def _windows(value: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """First tokens of the windows that lie inside one text."""
    n = max(len(value) - width + 1, 0)
    return np.flatnonzero(text[:n] == text[width - 1 : width - 1 + n])


def _hashes(value: np.ndarray, width: int) -> list[np.ndarray]:
    """For each mask, its hash of every window; one whole hash for other widths."""
    n = max(len(value) - width + 1, 0)
    terms = [value[k : k + n] * w for k, w in enumerate(_weights(width))]
    total = sum(terms, np.full(n, width, np.uint64))
    if width < WINDOW:
        return [total]
    return [total - sum((terms[k] for k in gone), np.full(n, 64 + m, np.uint64)) for m, gone in enumerate(masks())]


def _tokens(value: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(value, width)[at]


NO_ITEM = -(1 << 63)
# Each token of a document has a seed for each mask, so few of them may pass by chance.
SEED_BITS = 256
SEEDS = "owner bigint, seed bigint, at int, tokens binary"


def _seed_table(texts: DataFrame, widths: list[int], only: np.ndarray | None, whole: int | None) -> DataFrame:
    """(owner, seed, at, tokens) of the windows of each text, those that ``only`` lets through.

    With ``whole``, texts of fewer tokens than the window give one window each, of
    all their tokens, if they have that many; ``widths`` are those looked for.
    """
    schema = pa.schema([("owner", pa.int64()), ("seed", pa.int64()), ("at", pa.int32()), ("tokens", pa.binary())])

    def seeded(batches):
        for batch in batches:
            owners = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, data, offsets in chunks(batch.column(1)):
                _, _, text, value = find_words(data, offsets, ascii_fold(punctuation=True))
                first = np.searchsorted(text, np.arange(len(offsets)))
                count = np.diff(first)
                for width in widths:
                    at = _windows(value, text, width)
                    if whole is not None:
                        long_enough = count[text[at]] >= WINDOW if width == WINDOW else count[text[at]] == width
                        at = at[long_enough & (width >= whole)]
                    if not len(at):
                        continue
                    for seed in _hashes(value, width):
                        key, hit = seed[at].view(np.int64), at
                        if only is not None:
                            let = passes(only, key)
                            key, hit = key[let], at[let]
                        if len(hit):
                            tokens = np.ascontiguousarray(_tokens(value, hit, width))
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(owners[row + text[hit]]),
                                    pa.array(key),
                                    pa.array((hit - first[text[hit]]).astype(np.int32)),
                                    pa.array([t.tobytes() for t in tokens], pa.binary()),
                                ],
                                schema=schema,
                            )

    return texts.mapInArrow(seeded, SEEDS)


def overlaps(docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap()) -> DataFrame:
    """Windows that documents share with benchmark items, summed up by text and item.

    Columns: doc_key (xxhash64 of the text), item_id, first_token and last_token of
    the text's windows that match, and the best number of equal tokens of a window.
    Tokens are words without ASCII punctuation, in lower case.
    """
    docs = docs.select(F.xxhash64("text").alias("owner"), "text").where("text is not null")
    owner = F.coalesce(F.col("item_id").cast("bigint"), F.lit(NO_ITEM))
    items = benchmark.select(owner.alias("owner"), "text").where("text is not null").distinct()
    every = list(range(how.least, WINDOW + 1))
    known = stored(_seed_table(items, every, None, how.least), "benchmark_seeds")
    widths = [r[0] for r in known.select((F.octet_length("tokens") / 8).cast("int")).distinct().collect()]
    hits = _seed_table(docs, sorted(widths), membership(known, "seed", SEED_BITS), None)
    known = known.select(
        "seed", F.col("owner").alias("item_id"), F.col("tokens").alias("item_tokens")
    )
    joined = split_join(hits, known, ["seed"]).select("owner", "at", "item_id", "tokens", "item_tokens")
    schema = pa.schema([
        ("doc_key", pa.int64()), ("item_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("equal", pa.int32()),
    ])

    def compared(batches):
        for batch in batches:
            rows = []
            for owner, at, item, ours, theirs in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                same = int(np.count_nonzero(np.frombuffer(ours, np.int64) == np.frombuffer(theirs, np.int64))) if len(ours) == len(theirs) else 0
                width = len(ours) // 8
                if same >= (width - how.substitutions if width == WINDOW else width):
                    rows.append((owner, item, at, at + width - 1, same))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    found = joined.mapInArrow(compared, "doc_key bigint, item_id bigint, first int, last int, equal int")
    return found.groupBy("doc_key", "item_id").agg(
        F.min("first").cast("bigint").alias("first_token"),
        F.max("last").cast("bigint").alias("last_token"),
        F.max("equal").cast("bigint").alias("equal_tokens"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap()) -> DataFrame:
    """(doc_id, item_id, first_token, last_token, equal_tokens) of each leak.

    A row for each pair of a document and an item that share a window. Null and empty
    texts leak nothing. Items with a null item_id are left out, as there is no name for
    them (``decontaminated`` counts them); a null doc_id keeps its row; repeated rows of
    documents repeat theirs. No rows give no rows.
    """
    found = overlaps(docs, benchmark, how)
    keyed = docs.where("text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("doc_key")
    )
    named = found.where(F.col("item_id") != NO_ITEM)
    return split_join(keyed, named, ["doc_key"]).drop("doc_key")


def decontaminated(docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap()) -> DataFrame:
    """The documents without a leak, with all their columns, whatever their names.

    Items with a null item_id count like others. Null texts and doc_ids and repeated rows stay. Without items all documents stay.
    """
    key = unused("_text_key", docs)
    leaks = stored(overlaps(docs, benchmark, how).select(F.col("doc_key").alias(key)).distinct(), "leaks")
    keyed = docs.withColumn(key, F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    clean, rest = set_apart(keyed, F.col(key), leaks, key)
    return clean.unionByName(split_join(rest, leaks, [key], "left_anti").select(keyed.columns)).select(docs.columns)
