import random
import re

import numpy as np
import pytest
from gleanery.llm import common as C
from gleanery.llm import licenses as L

SF = "/root/testdata/sf0.001"


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", line)] for line in low.split("\n")]


def base(text):
    w = [x for line in plain(text) for x in line]
    found = [(i, label) for phrase, label in L.PHRASES.items() for q in [phrase.split()] for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), sorted({x for _, x in found})


def in_order(words, template):
    """The largest share of a template that a stretch of the words has in order, with all words that tell a short template from others."""
    t, label = template.split(), L.TEMPLATES[template]
    others = {w for x, other in L.TEMPLATES.items() if other != label for w in x.split()}
    telling, best = {w for w in t if w not in others} if len(t) < 10 else set(), 0.0
    for i, first in enumerate(words):
        stretch = words[i : i + -(-len(t) * 3 // 2)]
        if first not in t or not telling <= set(stretch):
            continue
        row = [0] * (len(t) + 1)
        for word in stretch:
            row = [0] + [max(a, b, c) for a, b, c in _steps(row, t, word)]
            for j in range(1, len(row)):
                row[j] = max(row[j], row[j - 1])
        best = max(best, row[-1] / len(t))
    return best if best >= L.CONTAINED - 1e-9 else 0.0


def _steps(row, t, word):
    return [(row[j + 1], row[j] + (w == word), 0) for j, w in enumerate(t)]


def joined(text):
    """Templates met by a block, all pairs compared."""
    met = {}
    for line in plain(text):
        starts = range(0, max(1, len(line) - L.BLOCK + L.BLOCK // 2), L.BLOCK // 2)
        for s in starts:
            block = set(line[s : s + L.BLOCK])
            for t, label in L.TEMPLATES.items():
                own = set(t.split())
                share = in_order(line[s : s + L.BLOCK], t) if len(own & block) / len(own) >= L.CONTAINED else 0
                if share:
                    met[label] = max(share, met.get(label, 0))
    return met


def check(rows, texts):
    for r in rows:
        n, places, first, last, labels = base(texts[r.doc_id])
        met = joined(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, places, first, last, ",".join(labels))
        assert r.labels == ",".join(sorted({*labels, *met}))
        assert r.score == pytest.approx(1.0 if places else max(met.values(), default=0.0))


def test_scan_by_brute_force(spark):
    docs = C.table(spark, SF, "documents")
    check(L.op6_license_scans(spark, SF).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_every_block_that_meets_a_template_is_found(spark):
    rng = random.Random(9)
    words = sorted({w for t in L.TEMPLATES for w in t.split()})
    texts = ["Apache License", "THE MIT LICENSE. MIT  License", "cc-by 4.0 gnu\ngeneral public license", None, "", "ÀCC by", "ccby cc BY"]
    for _ in range(150):
        t = rng.choice(list(L.TEMPLATES)).split()
        kept = [w for w in t if rng.random() < rng.choice([0.7, 0.85, 1.0])]
        noise = [rng.choice(words) for _ in range(rng.choice([0, 5, 300]))]
        if rng.random() < 0.3:
            rng.shuffle(kept)
        at = rng.randint(0, len(noise))
        texts.append(" ".join(noise[:at] + kept + noise[at:]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = L.scan(docs).collect()
    check(rows, dict(enumerate(texts)))
    assert sum("," in r.labels for r in rows) and sum(r.score > 0 for r in rows) > 60


WRAPPED = {
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
}


def whole(text):
    """Templates met by half-overlapping blocks of the whole text, all pairs compared."""
    words = [x for line in plain(text) for x in line]
    met = {}
    for s in range(0, max(1, len(words) - L.BLOCK + L.BLOCK // 2), L.BLOCK // 2):
        block = set(words[s : s + L.BLOCK])
        for t, label in L.TEMPLATES.items():
            share = in_order(words[s : s + L.BLOCK], t) if len(set(t.split()) & block) / len(set(t.split())) >= L.CONTAINED else 0
            if share:
                met[label] = max(share, met.get(label, 0))
    return met


def test_a_notice_over_several_lines_is_met(spark):
    rng = random.Random(3)
    texts, labels = [], []
    for label, notice in WRAPPED.items():
        for lines in (2, 3):
            for before in (0, 100, 250, 700):
                size = -(-len(notice.split()) // lines)
                rows = [" ".join(notice.split()[i : i + size]) for i in range(0, len(notice.split()), size)]
                noise = "\n".join(" ".join(f"w{rng.randrange(999)}" for _ in range(10)) for _ in range(before // 10))
                texts.append(noise + "\n * " + "\n * ".join(rows) + "\n" + noise)
                labels.append(label)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = L.scan(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        met = whole(texts[r.doc_id])
        assert labels[r.doc_id] in r.labels.split(",") and r.labels == ",".join(sorted(met)) and r.score == pytest.approx(max(met.values()))
    # the filters against all pairs, over words that many templates share and lines of any length
    vocab = sorted({w for t in L.TEMPLATES for w in t.split()} | {f"w{i}" for i in range(40)})
    texts = ["".join(rng.choice(vocab) + rng.choice("   \n") for _ in range(rng.choice([40, 140, 200, 300, 600]))) for _ in range(60)]
    got = L.scan_texts(texts, L.Templates({}))
    for i, text in enumerate(texts):
        met = {k: max(whole(text).get(k, 0), joined(text).get(k, 0)) for k in {**whole(text), **joined(text)}}
        assert got["labels"][i] == ",".join(sorted({*base(text)[4], *met}))
        assert got["score"][i] == pytest.approx(1.0 if base(text)[1] else max(met.values(), default=0.0))


def test_positions_on_both_sides_prune_pairs():
    """A block that holds a prefix word of a template too late for enough words to follow is no candidate; none that meets is lost."""
    templates = L.Templates({})
    order = templates.vocab[np.argsort(templates.place)]
    names = {int(L.word_hashes(w)[0]): w for t in L.TEMPLATES for w in t.split()}
    rng = random.Random(4)
    texts = []
    for _ in range(200):
        at = sorted(rng.sample(range(len(order)), rng.choice([8, 12, 20, 40])))
        texts.append(" ".join(names[int(order[i])] for i in at))
    texts += list(L.TEMPLATES)
    block, place, docs = templates.words(L.Words(texts))
    left = {divmod(int(x), len(L.TEMPLATES)) for x in templates.candidates(block, place)}
    pruned = 0
    for b in range(len(texts)):
        own = [int(p) for p in place[block == b]]
        for t, text in enumerate(L.TEMPLATES):
            words = [i for i, h in enumerate(order) if names[int(h)] in text.split()]
            need = int(templates.need[t])
            meets = any(p in words[: len(words) - need + 1] for p in own) and len(own) >= need
            bound = max((1 + min(len(words) - words.index(p) - 1, len(own) - q - 1) for q, p in enumerate(own) if p in words), default=0)
            assert ((b, t) in left) == (bound >= need)
            pruned += meets and (b, t) not in left
            assert (b, t) in left or len(set(own) & set(words)) < need
    assert pruned > 0 and list(docs[0]) == list(range(len(texts)))


def test_awkward_documents(awkward, nothing):
    rows = L.scan(awkward).collect()
    assert len(rows) == awkward.count() and all(r.n_words == 0 and r.labels == "" and r.score == 0 for r in rows if r.doc_id == 0)
    assert L.scan(nothing).count() == 0


def test_text_that_is_no_license_gets_no_label(spark):
    """All words of a template, or most, but not its telling ones, not in order, or far apart."""
    texts = [
        "The album was released under the label that he had founded, and the driver lost a license.",
        "It is licensed under the gnu license, version 2.0 of which is old.",
        "All rights are reserved by no one; this part of the publication may be printed and, without permission of the publisher, be written prior to this and reproduced.",
        "Permission of the person: any copy, free software and associated files, obtaining this documentation. The charge is granted hereby to a of.",
        "licensed " + "x " * 20 + "under the apache license " + "y " * 20 + "version 2 0",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.labels.replace("apache", ""), r.score < 1.01) for r in L.scan(docs).orderBy("doc_id").collect()] == [("", True)] * 5
    assert [L.scan_texts([t], L.Templates({}))["labels"][0] for t in texts] == ["", "", "", "", "apache"]  # the last by the base phrase alone
