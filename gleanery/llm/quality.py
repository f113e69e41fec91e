"""Quality classifier by supervised subword embeddings.

A document is the mean of the vectors of its hashed words and word pairs plus the mean of the vectors of its hashed
character n-grams; a softmax layer reads it. Vectors and layer are learned together by stochastic gradient descent in numpy
on a bounded sample of labelled rows (``FIT_ROWS`` documents; of a longer one at most ``FIT_HITS`` words and as many n-grams,
drawn evenly over the whole text). Scoring reads whole texts. As the layer is linear, each bucket is given its logit once,
and a document needs two means of numbers.

Null and empty texts get the score of the bias. Without labels of both classes every score is the share of label 1 (0.5
without any label). Repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

BUCKETS = 1 << 17
DIM = 8
FIT_ROWS = 4000
FIT_HITS = 2048
GRAMS = (2, 3, 4)
REPEAT = np.uint64(1)  # the word pair "the same word again", whatever the word


def _space_table() -> np.ndarray:
    t = np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000)
    t[0] = True
    return t


_SPACE: list[np.ndarray] = []


def hits(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
    """Buckets of words and word pairs, and of character n-grams: (buckets, number per text) for each kind of hit."""
    if not _SPACE:
        _SPACE.append(_space_table())
    points, bounds = C.codepoints(texts)
    starts, ends = C.spans(~_SPACE[0][points])
    h = C.span_hashes(points, starts, ends)
    n = np.diff(np.searchsorted(starts, bounds))
    pairs = np.where(h[1:] == h[:-1], REPEAT, C.mix(h[:-1] * np.uint64(3) + h[1:]))
    owner = np.repeat(np.arange(len(texts)), n)
    pairs = pairs[owner[1:] == owner[:-1]]
    mask = np.uint64(BUCKETS - 1)
    by_word = [((h & mask).astype(np.int64), n), ((pairs & mask).astype(np.int64), np.maximum(n - 1, 0))]
    by_char, lens = [], np.diff(bounds) - 1
    stop = np.repeat(bounds[1:] - 1, lens + 1)
    wide = points.astype(np.uint32)
    for size in GRAMS:
        grams = np.zeros(max(len(points) - size + 1, 0), np.uint32)
        for k in range(size):
            grams = (grams ^ wide[k : k + len(grams)]) * np.uint32(0x01000193 + 2 * size)
        keep = np.arange(len(grams)) + size <= stop[: len(grams)]
        grams ^= grams >> np.uint32(15)
        by_char.append(((grams[keep] & np.uint32(BUCKETS - 1)).astype(np.int64), np.maximum(lens - size + 1, 0)))
    return by_word, by_char


def _per_text(kinds, t: int, offsets) -> np.ndarray:
    return np.concatenate([ids[o[t] : o[t + 1]] for (ids, _), o in zip(kinds, offsets, strict=True)])


def _training_rows(texts: list[str], part: pa.RecordBatch) -> dict:
    doc_ids, groups = part.column("doc_id").to_pylist(), []
    for kinds in hits(texts):
        offsets = [np.concatenate([[0], np.cumsum(n)]) for _, n in kinds]
        drawn = []
        for t in range(len(texts)):
            drawn.append(C.draw(_per_text(kinds, t, offsets), FIT_HITS, doc_ids[t]))
        groups.append(C.lists(np.concatenate(drawn), np.array([len(d) for d in drawn]), pa.int32()))
    return {"w": groups[0], "c": groups[1]}


class Embeddings:
    """Vectors per bucket and the softmax layer; ``logits`` is what scoring needs: the difference of both classes per bucket, and the bias."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.e = (rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
        self.w = np.zeros((DIM, 2), np.float32)
        self.b = np.zeros(2, np.float32)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 6, size: int = 32, rate: float = 0.3, seed: int = 2) -> Embeddings:
        rng = np.random.default_rng(seed)
        se, sw, sb = np.full(BUCKETS, 1e-8, np.float32), np.full_like(self.w, 1e-8), np.full(2, 1e-8, np.float32)
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // size)):
                both = [g for i in at for g in rows[i]]
                counts = np.array([len(g) for g in both])
                ids, share = np.concatenate(both), np.repeat(1 / np.maximum(counts, 1), counts).astype(np.float32)
                doc = np.repeat(np.repeat(np.arange(len(at)), 2), counts)
                v = self.e[ids] * share[:, None]
                x = np.stack([np.bincount(doc, v[:, d], len(at)) for d in range(DIM)], 1).astype(np.float32)
                z = x @ self.w + self.b
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(at)), y[at]] -= 1
                gw, gb, gx = x.T @ p, p.sum(0), p @ self.w.T
                order = np.argsort(ids, kind="stable")
                cut = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0])) if len(ids) else []
                if len(ids):
                    g = np.add.reduceat((gx[doc] * share[:, None])[order], cut, axis=0)
                    rows_at = ids[order][cut]
                    se[rows_at] += (g * g).mean(1)
                    self.e[rows_at] -= step * g / np.sqrt(se[rows_at])[:, None]
                sw += gw * gw
                sb += gb * gb
                self.w -= step * gw / np.sqrt(sw)
                self.b -= step * gb / np.sqrt(sb)
        return self

    def logits(self) -> tuple[np.ndarray, float]:
        return (self.e @ (self.w[:, 1] - self.w[:, 0])).astype(np.float32), float(self.b[1] - self.b[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """Learn from at most ``rows`` labelled documents: what comes to the driver is bounded by rows x 2 x FIT_HITS numbers."""
    sample = C.labelled(docs, labels, label, rows)
    order, y, parts = C.gathered(C.map_texts(sample, "doc_id long, label int, w array<int>, c array<int>", _training_rows), "w", "c")
    y = y.astype(np.int64)
    if len(set(y.tolist())) < 2:
        share = y.mean() if len(y) else 0.5
        return np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    w, c = ([v for ids, counts in own for v in np.split(ids, np.cumsum(counts)[:-1])] for own in parts)
    return Embeddings().fit([(w[i], c[i]) for i in order], y).logits()


def score_texts(texts: list[str], logits: np.ndarray, bias: float) -> np.ndarray:
    z = np.full(len(texts), bias)
    for kinds in hits(texts):
        n = sum(counts for _, counts in kinds)
        z += sum(C.group_sums(logits[ids], counts) for ids, counts in kinds) / np.maximum(n, 1)
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """docs with the column ``score`` (0 to 1); a column of that name is replaced. The model shipped to the tasks has a fixed size."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    return C.scored(docs, lambda texts: score_texts(texts, *kept.value))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs, C.table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    held = C.crc_fold(F.col("doc_id"), 4) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
