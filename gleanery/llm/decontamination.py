"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Test items are partitioned by their number of distinct five-word shingles, in powers of two. For each size a document is cut
into blocks of as many shingles as an item of that size can have, and two blocks in a row make a window: an item copied into
a document lies whole in a window at most four times its size, so its MinHash agrees with the window's in a quarter of the
coordinates or more, however long the document is. Windows that agree in one of ``COORDINATES`` are candidates (a copy of 80 %
is missed with a chance of about 2e-5); then the share of the item's distinct shingles that the whole document holds decides.

The benchmark is a stated query set: it is taken in blocks of bounded size, each shipped to a pass over the documents. Items
under five words have no five-word shingle. With ``short`` they are searched as a whole, exactly: a document that has their words
in a row holds them. Without it, as in the query and the pipeline's stage, they are not searched: a one-word item would take every document that
has the word. Items without an id can't be named as leaks, but documents that
hold one are dropped. Null and empty texts hold nothing. Repeated rows are searched each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

CONTAINED = 0.8
COORDINATES = 48
BLOCK_ITEMS = 4000
BLOCK_WORDS = 400_000


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(1 << 63, size=COORDINATES, dtype=np.uint64), rng.integers(1 << 63, size=COORDINATES, dtype=np.uint64) | np.uint64(1)


class Items:
    """A block of test items: their shingles, and for each size their minima by coordinate."""

    def __init__(self, ids: list[int], texts: list[str], short: bool = False):
        values, counts = C.shingles(texts)
        n_words = C.words(texts)[1]
        long_enough = n_words >= 5
        ends = np.cumsum(counts)
        self.ids, self.shingles = [], []
        for i, (e, n) in enumerate(zip(ends, counts, strict=True)):
            if long_enough[i]:
                self.ids.append(ids[i])
                self.shingles.append(np.unique(values[e - n : e]))
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by number of words: sorted hashes of the whole items, and their numbers
        for n in range(1, 5) if short else ():
            own = np.flatnonzero(n_words == n)
            if len(own):
                h = C.shingles([texts[i] for i in own], n)[0]
                order = np.argsort(h, kind="stable")
                self.short[n] = h[order], len(self.ids) + order
                self.ids += [ids[i] for i in own]
        self.xor, self.mul = _seeds()
        self.sizes: dict[int, tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]] = {}
        by_size: dict[int, list[int]] = {}
        for i, s in enumerate(self.shingles):
            by_size.setdefault(1 << math.ceil(math.log2(len(s))), []).append(i)
        for block, own in sorted(by_size.items()):
            minima = np.stack([[((self.shingles[i] ^ x) * m).min() for x, m in zip(self.xor, self.mul, strict=True)] for i in own])
            sorted_ = []
            for k in range(COORDINATES):
                order = np.argsort(minima[:, k], kind="stable")
                sorted_.append((minima[order, k], np.array(own)[order]))
            self.sizes[block] = sorted_

    def candidates(self, values: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs of which a window agrees in a coordinate."""
        found: set[tuple[int, int]] = set()
        if not len(values) or not self.sizes:
            return found
        for k in range(COORDINATES):
            level, n = (values ^ self.xor[k]) * self.mul[k], counts
            width = 1
            for block, sorted_ in self.sizes.items():
                step = block // width
                n_new = -(-n // step)
                cuts = np.repeat(np.cumsum(n) - n, n_new) + C.ramp(n_new) * step
                level, n, width = np.minimum.reduceat(level, cuts), n_new, block
                owner = np.repeat(np.arange(len(counts)), n)
                pair = np.where(owner[1:] == owner[:-1], np.minimum(level[1:], level[:-1]), level[:-1])
                window = np.append(pair, level[-1])
                keys, items = sorted_[k]
                lo = np.searchsorted(keys, window, "left")
                hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == window)
                for w, a in zip(hit, lo[hit], strict=True):
                    while a < len(keys) and keys[a] == window[w]:
                        found.add((int(owner[w]), int(items[a])))
                        a += 1
        return found

    def search(self, texts: list[str], contained: float) -> list[tuple[int, int, int, float]]:
        """(text, item number, shared shingles, containment) of all verified pairs."""
        values, counts = C.shingles(texts)
        ends, out, own, last = np.cumsum(counts), [], None, -1
        for t, i in sorted(self.candidates(values, counts)):
            if t != last:
                own, last = np.unique(values[ends[t] - counts[t] : ends[t]]), t
            shared = int(np.isin(self.shingles[i], own, assume_unique=True).sum())
            if shared >= contained * len(self.shingles[i]) - 1e-9:
                out.append((t, i, shared, shared / len(self.shingles[i])))
        for n, (keys, numbers) in self.short.items():
            values, counts = C.shingles(texts, n)
            lo, hi = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
            item = numbers[np.repeat(lo, hi - lo) + C.ramp(hi - lo)]
            text = np.repeat(np.repeat(np.arange(len(texts)), counts), hi - lo)
            out += [(int(t), int(i), 1, 1.0) for t, i in sorted(set(zip(text.tolist(), item.tolist(), strict=True)))]
        return out


def item_blocks(benchmark: DataFrame, named: bool = True, short: bool = False) -> list[Items]:
    """The benchmark in blocks of about BLOCK_ITEMS items and BLOCK_WORDS words; more items make more blocks, not larger ones. With ``named``, only items with an id."""
    items = benchmark.filter(F.col("text").isNotNull() & (F.col("item_id").isNotNull() | F.lit(not named))).select("item_id", "text")
    n, words = items.agg(F.count("*"), F.sum(F.size(F.split("text", r"\s+")))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil((words or 0) / BLOCK_WORDS))
    out = []
    for b in range(blocks):
        rows = sorted(items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        if rows:
            out.append(Items([r[0] for r in rows], [r[1] for r in rows], short))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED, short: bool = False) -> DataFrame:
    """doc_id, item_id, shared (shingles) and containment of every document that holds a test item."""
    schema, found = "doc_id long, item_id long, shared long, containment double", None
    docs = docs.select("doc_id", "text")
    for items in item_blocks(benchmark, short=short) or [Items([], [])]:
        kept = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, kept=kept):
            for part, texts in C.text_blocks(batches):
                rows = kept.value.search(texts, contained)
                at = pa.array([t for t, *_ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()).take(at), pa.array([kept.value.ids[i] for _, i, *_ in rows], pa.int64()), pa.array([s for *_, s, _ in rows], pa.int64()), pa.array([c for *_, c in rows], pa.float64())],
                    names=["doc_id", "item_id", "shared", "containment"],
                )

        hits = docs.mapInArrow(run, schema)
        found = hits if found is None else found.unionAll(hits)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED, short: bool = False) -> DataFrame:
    """docs without the rows that hold a test item; nothing is shuffled."""
    for items in item_blocks(benchmark, named=False, short=short):
        kept = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, kept=kept):
            for part, texts in C.text_blocks(batches):
                bad = {t for t, *_ in kept.value.search(texts, contained)}
                yield part.filter(pa.array([i not in bad for i in range(len(texts))]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


# Without the search: all shingles of documents and items joined.
ORACLE = f"""
WITH d AS ({C.SQL_WORDS.format(id="doc_id", table="documents")}), ds AS (SELECT DISTINCT r, doc_id, unnest({C.SQL_SHINGLES}) AS g FROM d WHERE len(w) >= 5),
i AS ({C.SQL_WORDS.format(id="item_id", table="benchmark")}), xs AS (SELECT DISTINCT r, item_id, unnest({C.SQL_SHINGLES}) AS g FROM i WHERE len(w) >= 5), n AS (SELECT r, count(*) AS n FROM xs GROUP BY r)
SELECT doc_id, item_id, count(*) AS shared, count(*) / any_value(n.n) AS containment FROM ds JOIN xs USING (g) JOIN n ON xs.r = n.r GROUP BY ds.r, doc_id, xs.r, item_id HAVING 10 * count(*) >= 8 * any_value(n.n)
"""
