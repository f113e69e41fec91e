"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A block is ``BLOCK`` words of the whole text, whatever lines they stand on, each starting half a block after the one before, so
that a notice of half a block lies whole in one; lines of more than half a block are cut into such blocks of their own besides.
A block meets a template if it holds at least ``CONTAINED`` of the template's distinct words. The join is exact: words are
ordered by how many places they have in the corpus, rarest first (a pass over all documents counts them); words of no template
come before all others and can't be common, so they are left out. The words of a block are put into the same order, and ``need``
distinct ones are the least it must have (length filter). The first common word of a pair is one of the first ``|T| - need + 1``
words of the template and of the first ``|B| - need + 1`` of the block (prefix filter on both sides), for 1 + the smaller number
of words that follow it on either side bounds the overlap (positional filter). What passes is counted word by word.

A block of many words can hold a template's words by chance. So a block that the join has found gets the label only if a stretch of
it, at most ``STRETCH`` times the template's words long, has ``CONTAINED`` of them in the template's order, and, of a template of less than
``SHORT`` words, all that tell it from the templates of other labels.

Null, empty and word-free texts have no words, no labels and score 0. Repeated rows are scanned each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

CONTAINED = 0.8
BLOCK = 256
STRETCH = 1.5
SHORT = 10
# The phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Sentences by which licenses are granted.
TEMPLATES = {
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "all rights reserved no part of this publication may be reproduced without prior written permission of the publisher": "reserved",
}


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with A-Z lower-cased, a zero after each text, and where each text starts (with the end as a last entry)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8).copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    return data, np.concatenate([[0], np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))])


_IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


class Words:
    """Word hashes of a block of texts, with the text and line of each."""

    def __init__(self, texts: list[str]):
        data, bounds = _bytes(texts)
        starts, ends = C.spans(_IN_WORD[data])
        self.h = C.span_hashes(data, starts, ends)
        at = np.searchsorted(starts, bounds)
        self.first, self.n = at[:-1], np.diff(at)
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        self.line = np.searchsorted(np.flatnonzero(data == 10), starts) + self.doc  # another number for each line of each text


def word_hashes(phrase: str) -> np.ndarray:
    return Words([phrase]).h


def phrase_places(w: Words) -> dict[str, np.ndarray]:
    """Places (numbers of words in the block of texts) where each phrase starts."""
    found = {}
    for phrase in PHRASES:
        own = word_hashes(phrase)
        n = len(w.h) - len(own) + 1
        if n <= 0:
            found[phrase] = np.zeros(0, np.int64)
            continue
        fits = w.doc[:n] == w.doc[len(own) - 1 :]
        for k, h in enumerate(own):
            fits &= w.h[k : k + n] == h
        found[phrase] = np.flatnonzero(fits)
    return found


def blocks(w: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each block that one of the words ``hit`` lies in with the number of that word in hit, and of every block its text, first word and end."""
    step = BLOCK // 2
    line_at = np.flatnonzero(np.concatenate([[True], np.diff(w.line) != 0]))
    line_size = np.diff(np.append(line_at, len(w.h)))
    of, number, docs, total = [], [], [], 0
    for starts, size, unit, own in (
        (w.first, w.n, w.doc[hit], np.arange(len(w.n))),
        # a line of at most half a block lies whole in a block of the text
        (line_at, np.where(line_size > step, line_size, 0), np.searchsorted(line_at, hit, "right") - 1, w.doc[line_at]),
    ):
        n = np.where(size > 0, 1 + np.maximum(0, -((BLOCK - size) // step)), 0)
        base = total + np.cumsum(n) - n
        k = np.flatnonzero(n[unit])
        unit = unit[k]
        offset = hit[k] - starts[unit]
        last = np.minimum(offset // step, n[unit] - 1)  # the last block of the unit reaches its end
        both = (last > 0) & (offset < (last - 1) * step + BLOCK)
        of += [base[unit] + last, (base[unit] + last - 1)[both]]
        number += [k, k[both]]
        begin = np.repeat(starts, n) + C.ramp(n) * step
        docs.append(np.stack([np.repeat(own, n), begin, np.minimum(begin + BLOCK, np.repeat(starts + size, n))]))
        total += int(n.sum())
    return np.concatenate(of), np.concatenate(number), np.concatenate(docs, axis=1)


class Templates:
    """Distinct words of every template, rarest first, and the prefixes of the templates."""

    def __init__(self, counts: dict[int, int]):
        own = [{int(h) for h in word_hashes(text)} for text in TEMPLATES]
        order = sorted(set().union(*own), key=lambda h: (counts.get(h, 0), h))
        self.labels = list(TEMPLATES.values())
        self.size = np.array([len(words) for words in own])
        self.need = np.array([math.ceil(CONTAINED * len(words) - 1e-9) for words in own])
        self.vocab = np.array(sorted(order), np.uint64)
        self.place = np.argsort(np.array(order, np.uint64))  # in the order, of each word of vocab
        self.member = np.array([[h in words for words in own] for h in order])
        left = self.member[::-1].cumsum(0)[::-1]  # words of each template from a place of the order on
        self.left = np.where(self.member, left, 0)
        self.sequence = [word_hashes(text) for text in TEMPLATES]
        others = [set().union(*[x for x, label in zip(own, self.labels, strict=True) if label != mine]) for mine in self.labels]
        self.telling = [np.array(sorted(words - other), np.uint64) if len(seq) < SHORT else np.zeros(0, np.uint64) for words, other, seq in zip(own, others, self.sequence, strict=True)]

    def in_order(self, h: np.ndarray, t: int) -> float:
        """The largest share of template t that a stretch of the words h has in order; 0 if that is under the threshold or no such stretch has all telling words."""
        seq, telling = self.sequence[t], self.telling[t]
        wide = math.ceil(STRETCH * len(seq))
        match = h[:, None] == seq[None, :]
        starts = np.flatnonzero(match.any(1))
        match = np.concatenate([match, np.zeros((wide, len(seq)), bool)])
        best = np.zeros((len(starts), len(seq) + 1), np.int32)  # longest common subsequence of the stretch so far with each prefix of the template
        for k in range(wide):
            best[:, 1:] = np.maximum(best[:, 1:], best[:, :-1] + match[starts + k])
            np.maximum.accumulate(best, axis=1, out=best)
        share = best[:, -1] / len(seq)
        good = share >= CONTAINED - 1e-9
        for word in telling:
            at = np.flatnonzero(h == word)
            following = np.searchsorted(at, starts)
            good &= (following < len(at)) & (at[np.minimum(following, len(at) - 1)] < starts + wide) if len(at) else False
        return float(share[good].max(initial=0.0))

    def words(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks and the distinct template words in them as places of the order, sorted by both, and the text of every block."""
        at = np.minimum(np.searchsorted(self.vocab, w.h), len(self.vocab) - 1)
        hit = np.flatnonzero(self.vocab[at] == w.h)
        if not len(hit):
            return hit, hit, hit
        block, number, docs = blocks(w, hit)
        keys = np.unique(block * len(self.vocab) + self.place[at[hit[number]]])
        return keys // len(self.vocab), keys % len(self.vocab), docs

    def candidates(self, block: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The pairs that the filters leave, as block x templates + template."""
        m = np.bincount(block)
        right = m[block] - (np.arange(len(block)) - (np.cumsum(m) - m)[block])  # words of the block from this one on
        e = np.flatnonzero(right >= self.need.min())
        i, t = np.nonzero((self.left[place[e]] >= self.need) & (right[e, None] >= self.need))
        return np.unique(block[e[i]] * len(self.need) + t)

    def join(self, w: Words) -> list[tuple[int, int, float]]:
        """All (text, template, share in order) of blocks that meet a template."""
        block, place, docs = self.words(w)
        if not len(block):
            return []
        pairs = self.candidates(block, place)
        of, t = pairs // len(self.need), pairs % len(self.need)
        start = np.searchsorted(block, of)
        size = np.searchsorted(block, of, "right") - start
        words = place[np.repeat(start, size) + C.ramp(size)]
        common = np.bincount(np.repeat(np.arange(len(pairs)), size), self.member[words, np.repeat(t, size)], len(pairs)).astype(np.int64)
        met = np.flatnonzero(common >= self.need[t])
        found = ((int(docs[0, of[k]]), int(t[k]), self.in_order(w.h[docs[1, of[k]] : docs[2, of[k]]], int(t[k]))) for k in met)
        return [f for f in found if f[2] > 0]


def template_counts(docs: DataFrame) -> dict[int, int]:
    """Places of each template word in all documents; a row per word and task reaches the shuffle, one per word the driver."""
    vocab = np.unique(np.concatenate([word_hashes(t) for t in TEMPLATES]))

    def run(batches):
        total = np.zeros(len(vocab), np.int64)
        for _, texts in C.text_blocks(batches):
            h = Words(texts).h
            at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
            total += np.bincount(at[vocab[at] == h], minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(vocab.view(np.int64)), pa.array(total)], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"] % (1 << 64): r["n"] for r in rows}


def scan_texts(texts: list[str], templates: Templates) -> dict:
    w, n = Words(texts), len(texts)
    n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    base: dict[int, set] = {}
    for phrase, at in phrase_places(w).items():
        docs = w.doc[at]
        own = at - w.first[docs]
        n_base += np.bincount(docs, minlength=n)
        np.minimum.at(first, docs, own)
        np.maximum.at(last, docs, own)
        for d in np.unique(docs):
            base.setdefault(int(d), set()).add(PHRASES[phrase])
    score, more = np.where(n_base > 0, 1.0, 0.0), {d: set(x) for d, x in base.items()}
    for d, t, contained in templates.join(w):
        more.setdefault(d, set()).add(templates.labels[t])
        score[d] = max(score[d], contained)
    none = n_base == 0
    return {
        "n_words": w.n, "n_base": n_base,
        "first_word": pa.array(first, mask=none), "last_word": pa.array(last, mask=none),
        "base_labels": [",".join(sorted(base.get(d, ()))) for d in range(n)], "labels": [",".join(sorted(more.get(d, ()))) for d in range(n)],
        "score": score,
    }


def scan(docs: DataFrame) -> DataFrame:
    """Per document: words, base phrases and the labels of both ways. ``score`` is the largest share of a template in order, 1 for a base phrase."""
    docs = docs.select("doc_id", "text")
    templates = docs.sparkSession.sparkContext.broadcast(Templates(template_counts(docs)))  # a fixed set of sentences
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return C.map_texts(docs, schema, lambda texts, _: scan_texts(texts, templates.value))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(C.table(spark, sf_dir, "documents"))
