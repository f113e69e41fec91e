import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from gleanery.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "don't", "!!", "é", " ", "　", "1", "23", " x", "<|endoftext|>", "\r\n", "日本", "\x1c", "\x85", ".", " ", "ſ"]


def test_chunks_give_the_ids_of_the_whole_text():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", " ", "\n", " a"]
    enc = P.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        ids, n = enc.encode(texts)
        for t, end, count in zip(texts, np.cumsum(n), n, strict=True):
            assert ids[end - count : end].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "KEPT_CHUNKS", 50)
    enc = P.Encoder(PATH)
    for i in range(5):
        enc.encode([" ".join(f"w{i}x{j}" for j in range(40))])
        assert len(enc.size) == len(enc.keys) <= 80 and (np.diff(enc.keys.astype(object)) > 0).all()  # a block of 40 comes in whole
    texts = [" ".join(f"w{i}x{j}" for j in range(35, 40)) for i in range(5)]
    ids, n = enc.encode(texts)
    assert ids.tolist() == [i for t in texts for i in enc.tokenizer.encode(t, add_special_tokens=False).ids]


@pytest.mark.parametrize("window", [2048, 64])
def test_round_trip(spark, awkward, window):
    docs = awkward.filter("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = sorted(P.pack(docs, PATH, window).collect(), key=lambda r: (r.sequence_id, r.offset))
    tok = P.Encoder(PATH).tokenizer
    at = {d: 0 for d in texts}
    ids = {d: np.array([*tok.encode(t, add_special_tokens=False).ids, P.END_ID], "<u4") for d, t in texts.items()}
    glob = 0
    for r in rows:
        assert r.sequence_id * window + r.offset == glob and 0 < r.length <= window - r.offset
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
        glob += r.length
    assert at == {d: len(x) for d, x in ids.items()}


def test_repeated_rows_null_ids_and_empty_tables(spark, awkward, nothing):
    rows = P.pack(awkward, PATH).collect()
    assert sum(r.length for r in rows if r.doc_id is None) == sum(r.doc_tokens for r in rows if r.doc_id is None and r.start == 0) > 1
    assert sum(r.start == 0 for r in rows) == awkward.count()
    assert P.pack(nothing, PATH).count() == 0
