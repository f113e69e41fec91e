"""Toxicity by a factorization machine over hashed terms.

Terms of a document are its distinct lower-cased words, their first four and five characters (inflected words share a stem),
and nothing else; ``score = sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>)``. The pair term lets an insult count for more
next to whom it is aimed at, and a word that is harmless by itself count only in company; additive weights can't. Weights and
factors are learned in numpy by stochastic gradient steps on a bounded sample of labelled rows (``FIT_ROWS`` documents, of a
longer one at most ``FIT_TERMS`` distinct terms). A term takes part if it is in ``LEAST`` sampled documents and its share of
label 1 is ``APART`` standard errors from that of all, or if it tells in company: with another term, whether that one tells or
not, its share is further from that of all, and from what both terms give by themselves, than chance would bring about in any
pair of terms (``in_company``). The rest, tens of thousands of words, would only be learned by heart. Scoring reads whole texts.

Null, empty and word-free texts get the bias alone. Without labels of both classes every score is the share of label 1 (0.5
without any label). Repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

BUCKETS = 1 << 20
FACTORS = 4
FIT_ROWS = 10000
FIT_TERMS = 4096
LEAST = 3
APART = 4.0
STEMS = (4, 5)
PAIRS_BY_CHANCE = 0.05
TERMS_AT_ONCE = 512


def terms(texts: list[str], active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct terms of each text, and how many each text has; with ``active``, only buckets that it marks."""
    points, bounds = C.codepoints([t.lower() for t in texts])
    starts, ends = C.spans(C.word_table()[points])
    owner = np.searchsorted(bounds, starts, "right") - 1
    ids, docs = [], []
    for kind, size in enumerate((0, *STEMS)):
        own = (ends - starts > size) if size else slice(None)
        s, e, o = starts[own], ends[own], owner[own]
        h = C.span_hashes(points, s, s + size if size else e)
        b = (C.mix(h + np.uint64(kind)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        if active is not None:
            use = active[b]
            b, o = b[use], o[use]
        ids.append(b)
        docs.append(o)
    keys = np.unique(np.concatenate(docs) * BUCKETS + np.concatenate(ids))
    return keys % BUCKETS, np.bincount(keys // BUCKETS, minlength=len(texts)).astype(np.int64)


def _training_rows(texts: list[str], part: pa.RecordBatch) -> dict:
    ids, counts = terms(texts)
    ends = np.cumsum(counts)
    drawn = [C.draw(ids[e - n : e], FIT_TERMS, d) for e, n, d in zip(ends, counts, part.column("doc_id").to_pylist(), strict=True)]
    return {"terms": C.lists(np.concatenate(drawn), np.array([len(d) for d in drawn]), pa.int32())}


class Machine:
    """w0, w and v over the active buckets; ``slot`` leads from a bucket to its row, or to -1."""

    def __init__(self, active: np.ndarray, seed: int = 1):
        self.active = active
        self.slot = np.full(BUCKETS, -1, np.int32)
        self.slot[active] = np.arange(len(active), dtype=np.int32)
        self.w0 = 0.0
        self.w = np.zeros(len(active), np.float32)
        self.v = (np.random.default_rng(seed).standard_normal((len(active), FACTORS)) * 0.01).astype(np.float32)

    def raw(self, slots: np.ndarray, counts: np.ndarray):
        n = len(counts)
        doc = np.repeat(np.arange(n), counts)
        v = self.v[slots]
        s = np.stack([np.bincount(doc, v[:, f], n) for f in range(FACTORS)], 1)
        z = self.w0 + np.bincount(doc, self.w[slots], n) + 0.5 * ((s * s).sum(1) - np.bincount(doc, (v * v).sum(1), n))
        return z, s, doc, v

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = 8, size: int = 64, rate: float = 0.1, decay: float = 1e-5, seed: int = 2) -> Machine:
        rng = np.random.default_rng(seed)
        self.w0 = float(np.log(y.mean() / (1 - y.mean())))
        gw2, gv2 = np.full(len(self.w), 1e-6, np.float32), np.full(len(self.w), 1e-6, np.float32)
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // size)):
                counts = np.array([len(rows[i]) for i in at])
                slots = np.concatenate([rows[i] for i in at])
                z, s, doc, v = self.raw(slots, counts)
                g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]
                self.w0 -= 0.02 * float(g.mean())
                if not len(slots):
                    continue
                order = np.argsort(slots, kind="stable")
                cut = np.flatnonzero(np.concatenate([[True], np.diff(slots[order]) != 0]))
                own = slots[order][cut]
                gw = np.add.reduceat(g[doc][order], cut) + decay * np.sign(self.w[own]) * size
                gv = np.add.reduceat((g[doc][:, None] * (s[doc] - v))[order], cut, axis=0) + decay * self.v[own] * size
                gw2[own] += gw * gw
                gv2[own] += (gv * gv).mean(1)
                self.w[own] -= rate * gw / np.sqrt(gw2[own])
                self.v[own] -= 0.3 * rate * gv / np.sqrt(gv2[own])[:, None]
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        ids, counts = terms(texts, self.slot >= 0)
        z = self.raw(self.slot[ids], counts)[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _evidence(ones: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """n KL(ones / n, share): chance brings ``ones`` or more (or less) of n about with a probability of at most exp of minus this."""
    f = np.clip(ones / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    return n * (f * np.log(f / share) + (1 - f) * np.log((1 - f) / (1 - share)))


def in_company(terms_: np.ndarray, counts: np.ndarray, y: np.ndarray, known: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Terms (numbers below len(known)) that tell by a pair: all pairs are counted, by products of blocks of the 0/1 matrix of documents and terms.

    Left out beforehand is only what no pair can lift over the bound: too few documents of label 1 and too few of label 0."""
    share = y.mean()
    least = np.log(max(1, len(known)) ** 2 / 2 / PAIRS_BY_CHANCE)
    own = np.flatnonzero((ones * -np.log(share) >= least) | ((known - ones) * -np.log(1 - share) >= least))
    slot = np.full(len(known), -1, np.int32)
    slot[own] = np.arange(len(own), dtype=np.int32)
    place = np.empty(len(y), np.int32)  # documents of label 1 first
    place[np.argsort(-y, kind="stable")] = np.arange(len(y), dtype=np.int32)
    row, at, first = np.repeat(place, counts), slot[terms_], int(y.sum())
    row, at = row[at >= 0], at[at >= 0]
    by_term = np.argsort(at, kind="stable")
    row, at = row[by_term], at[by_term]
    del by_term

    def block(a: int) -> np.ndarray:
        lo, hi = np.searchsorted(at, [a, a + TERMS_AT_ONCE])
        there = np.zeros((len(y), min(TERMS_AT_ONCE, len(own) - a)), np.float32)
        there[row[lo:hi], at[lo:hi] - a] = 1
        return there

    known, ones = known[own], ones[own]
    odds = np.log((ones + share) / (known - ones + 1 - share))  # log odds of label 1 with each term
    base, found = np.log(share / (1 - share)), np.zeros(len(own), bool)
    cuts = range(0, len(own), TERMS_AT_ONCE)
    for a in cuts:
        left = block(a).T
        for b in cuts[a // TERMS_AT_ONCE :]:
            right = block(b)
            one = left[:, :first] @ right[:first]
            n = one + left[:, first:] @ right[first:]
            # most pairs can't pass the bound whatever they are compared with beyond the share of all
            i, j = np.nonzero((one * -np.log(share) >= least) | ((n - one) * -np.log(1 - share) >= least))
            one, n = one[i, j].astype(np.float64), n[i, j].astype(np.float64)
            i, j = i + a, j + b
            alone = 1 / (1 + np.exp(-np.clip(odds[i] + odds[j] - base, -20, 20)))
            high, low = np.maximum(alone, share), np.minimum(alone, share)
            tells = (i != j) & (((one > n * high) & (_evidence(one, n, high) >= least)) | ((one < n * low) & (_evidence(one, n, low) >= least)))
            found[i[tells]] = found[j[tells]] = True
    return own[found]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS) -> Machine:
    """Learn from at most ``rows`` labelled documents: what comes to the driver is bounded by rows x FIT_TERMS numbers.

    The sample is held once, as 32-bit numbers: terms that too few documents have are left out before anything is copied."""
    sample = C.labelled(docs, labels, label, rows)
    order, y, (parts,) = C.gathered(C.map_texts(sample, "doc_id long, label int, terms array<int>", _training_rows), "terms")
    y = y.astype(np.float64)
    if len(set(y.tolist())) < 2:
        empty = Machine(np.zeros(0, np.int64))
        share = y.mean() if len(y) else 0.5
        empty.w0 = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return empty
    known = np.zeros(BUCKETS, np.int64)
    for ids, _ in parts:
        known += np.bincount(ids, minlength=BUCKETS)
    often = np.flatnonzero(known >= LEAST)
    slot = np.full(BUCKETS, -1, np.int32)
    slot[often] = np.arange(len(often), dtype=np.int32)
    rows_ = []
    while parts:
        ids, counts = parts.pop(0)
        ends = np.cumsum(counts)
        rows_ += [(s := slot[ids[e - n : e]])[s >= 0] for e, n in zip(ends, counts, strict=True)]
    rows_ = [rows_[i] for i in order]
    counts, terms_ = np.array([len(r) for r in rows_]), np.concatenate(rows_)
    known, share, ones = known[often], y.mean(), np.zeros(len(often))
    for r, label_of in zip(rows_, y, strict=True):
        if label_of:
            ones[r] += 1
    apart = np.abs(ones - known * share) / np.sqrt(known * share * (1 - share))
    use = np.union1d(np.flatnonzero(apart >= APART), in_company(terms_, counts, y, known, ones))
    del terms_
    m = Machine(often[use])
    inner = np.full(len(often), -1, np.int32)
    inner[use] = np.arange(len(use), dtype=np.int32)
    return m.fit([(s := inner[r])[s >= 0] for r in rows_], y)


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """docs with the column ``score`` (0 to 1); a column of that name is replaced. The model shipped to the tasks is bounded by BUCKETS."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    return C.scored(docs, lambda texts: kept.value.score(texts))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs, C.table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    held = C.crc_fold(F.col("doc_id"), 4) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
