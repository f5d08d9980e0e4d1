import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from adstream.llm.packing import Packing, pack

from .conftest import LONG


def test_pieces_give_back_every_document(texts):
    rows = [(1, "Hello world"), (2, None), (3, ""), (1, "Hello world"), (None, "é ü \n\n 123"), (4, LONG), (5, "<|endoftext|>"), (6, "<|endoftext|> a"), (7, "a  <|endoftext|><|endoftext|>  b<|endoftext|")]
    made = pack(texts(rows).repartition(3)).collect()
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = sorted((str(i), *coder.encode(t or "", add_special_tokens=False).ids, 1) for i, t in rows)
    documents = {}
    for r in sorted(made, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and r.offset + r.length <= 2048
        place = r.sequence_id * 2048 + r.offset - r.start
        documents.setdefault((place, str(r.doc_id)), []).extend(ids.tolist())
        assert r.cut_before == (r.start > 0) and r.cut_after == (r.start + r.length < r.doc_tokens)
    assert sorted((i, *ids) for (_, i), ids in documents.items()) == wanted
    full = np.zeros(max(r.sequence_id for r in made) + 1, int)
    for r in made:
        full[r.sequence_id] += r.length
    assert (full[:-1] == 2048).all()


def test_places_have_no_gaps(texts):
    made = pack(texts([(k, f"text {k} " * 50) for k in range(40)]).repartition(7), Packing(length=64)).collect()
    edges = sorted((r.sequence_id * 64 + r.offset, r.length) for r in made)
    assert edges[0][0] == 0
    assert all(a + n == b for (a, n), (b, _) in zip(edges, edges[1:], strict=False))


def test_no_documents(texts):
    assert pack(texts([])).collect() == []


def test_checksum_is_of_little_endian_ids(texts):
    from pyspark.sql import functions as F

    (r,) = pack(texts([(1, "a")])).withColumn("c", F.crc32("ids")).collect()
    assert r.c == zlib.crc32(np.frombuffer(r.ids, "<u4").tobytes())
