import zlib

import corpus_pipeline as P
import numpy as np
import public_tokenizers
from gleanery.llm import common as C
from gleanery.llm import packing, quality, toxicity

from .test_decontamination import brute as leaks
from .test_neardup import brute as classes

SF = "/root/testdata/sf0.001"


def test_run_by_brute_force(spark):
    docs, labels = C.table(spark, SF, "documents"), C.table(spark, SF, "labels")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts)
    good = quality.score_texts([texts[i] for i in ids], *quality.fit(docs, labels))
    ids = [i for i, s in zip(ids, good, strict=True) if s >= 0.7]
    bad = toxicity.fit(docs, labels).score([texts[i] for i in ids])
    ids = [i for i, s in zip(ids, bad, strict=True) if s < 0.3]
    ids = sorted(set(classes({i: texts[i] for i in ids}).values()))
    held = {d for d, _ in leaks({i: texts[i] for i in ids}, {r.item_id: r.text for r in C.table(spark, SF, "benchmark").collect()})}
    ids = [i for i in ids if i not in held]
    rows = sorted(P.run(spark, SF).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert sorted({r.doc_id for r in rows}) == ids and 0 < len(ids) < len(texts)
    enc, glob = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer, 0
    for r in rows:
        own = np.array([*enc.encode(texts[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(own)
        assert r.sequence_id * 2048 + r.offset == glob
        glob += r.length


def test_stages_keep_the_columns_of_documents(spark):
    docs = C.table(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "packing"]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert P.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
