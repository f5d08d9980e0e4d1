"""Concatenate-and-cut packing of token ids into sequences of one length.

Documents are tokenised once, into a table. Pass one sums tokens by the partition
that wrote them; prefix sums over those totals give every partition, and so every
document, its place in one endless row of ids. Pass two cuts that row at multiples
of the sequence length. Only the last sequence needs padding.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.tables import running_totals, stored


@dataclass(frozen=True)
class Packing:
    """Sequence length, closing id, and the ranks file of the tokenizer.

    ``ranks`` holds the vocabulary of byte_bpe_50k.json as ranks, and ``special`` its
    special tokens; both files give the same ids. The string of a special token in a
    text is that token, as that file has it.
    """

    length: int = 2048
    closing: int = 1
    ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)


@cache
def encoding(ranks: str, pattern: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        made = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "packing", pat_str=pattern, mergeable_ranks=made, special_tokens=dict(special)
    )


def token_table(docs: DataFrame, how: Packing) -> DataFrame:
    """Ids of each document, its partition, and the ids before it in the partition.

    Ids are written with two bytes where the vocabulary allows it.
    """

    def encoded(batches):
        coder = encoding(how.ranks, how.pattern, how.special)
        kind = np.uint16 if max(coder.max_token_value, how.closing) < 1 << 16 else np.uint32
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            made, sizes = [], []
            for text in batch.column(1):
                ids = coder.encode_to_numpy(text.as_py() or "", allowed_special="all")
                made.append(np.append(ids, how.closing).astype(kind).tobytes())
                sizes.append(len(ids) + 1)
            ends = before + np.cumsum(sizes, dtype=np.int64)
            columns = [
                batch.column(0),
                pa.array(np.full(len(sizes), part, np.int64)),
                pa.array(ends - sizes if sizes else ends),
                pa.array(sizes, pa.int64()),
                pa.array(np.full(len(sizes), kind().itemsize, np.int32)),
                pa.array(made, pa.binary()),
            ]
            before = int(ends[-1]) if sizes else before
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "part", "before", "doc_tokens", "width", "ids"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        encoded,
        "doc_id bigint, part bigint, before bigint, doc_tokens bigint, width int, ids binary",
    )


def pack(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """The pieces of all documents, with their ids as little-endian 32-bit numbers.

    Columns: doc_id, start (its document's ids before the piece), length, ids,
    doc_tokens, sequence_id, offset in the sequence, and whether the piece is the
    boundary record of a document cut at its front or back (cut_before, cut_after).
    A null or empty text is the closing id alone. Repeated rows and doc_ids, null
    ones too, are each packed. No rows give no pieces. Further columns are ignored.
    """
    tokens = stored(token_table(docs, how), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    starts = stored(running_totals(totals, "part", "total"), "token_offsets")
    placed = tokens.join(starts, "part").select(
        "doc_id", (F.col("before") + F.col("total")).alias("at"), "doc_tokens", "width", "ids"
    )
    length = how.length

    def cut(batches):
        for batch in batches:
            doc, at, size, width = (batch.column(k).to_pylist() for k in range(4))
            rows = []
            for k, ids in enumerate(batch.column(4)):
                ids = np.frombuffer(ids.as_buffer(), f"<u{width[k]}").astype("<u4")
                edges = np.arange(-(at[k] % length), size[k], length)
                for left in edges.tolist():
                    first, last = max(left, 0), min(left + length, size[k])
                    rows.append((
                        doc[k], first, last - first, ids[first:last].tobytes(), size[k],
                        (at[k] + first) // length, (at[k] + first) % length, first > 0, last < size[k],
                    ))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(piece.names, row, strict=True)) for row in rows], schema=piece
            )

    piece = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("cut_before", pa.bool_()), ("cut_after", pa.bool_()),
    ])
    return placed.mapInArrow(
        cut,
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, cut_before boolean, cut_after boolean",
    )
