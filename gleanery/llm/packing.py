"""Concatenate and cut: documents one after another, cut into windows of fixed length.

First pass: every document is tokenized once; its ids, their number and their offset within the partition are written to
shared space. The totals of the partitions (a number each) are summed to global offsets. Second pass: with its global offset
a document is cut where a window ends; a piece that starts or ends inside a document is a boundary record like any other. Only
the last window is short, and padding is what it lacks.

A null or empty text has the end id alone. Repeated rows are packed each. Column ``doc_id`` and the text are all that is read.
"""

from __future__ import annotations

import zlib
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

WINDOW = 2048
END_ID = 1
KEPT_CHUNKS = 2_000_000  # chunks whose ids a worker remembers, in some 35 bytes each; beyond that the older half is let go
KEPT_IDS = 16_000_000
TOGETHER = 20  # new chunks that are tokenized in one call
# White space as the tokenizer's pattern has it. A space before other than white space is a safe place to cut.
WHITE = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


class Encoder:
    """Token ids of whole texts, chunk by chunk.

    A byte-level tokenizer splits before every single space that is followed by other than white space, whatever stands
    before it. So the ids of a text are those of its chunks, and a chunk seen before is looked up: by a 64-bit hash in a sorted
    array, confirmed by a second one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.white = np.zeros(0x110000, bool)
        self.white[WHITE] = True
        self.other = C.mix(np.arange(0x110000, dtype=np.uint64))  # code points of the second hash
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # sorted by key
        self.slots = np.zeros(0, np.int32)  # of each key, in the order in which chunks were learned
        self.first, self.size, self.flat = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, self.dtype)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), self.dtype, int(counts.sum()))
        return flat, counts

    def _spaced(self, chunks: list[str], widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks that begin with a space, several in one call; the bytes of the tokens, and of the chunks, tell where a chunk ends."""
        flat, _ = self._whole(["".join(chunks[i : i + TOGETHER]) for i in range(0, len(chunks), TOGETHER)])
        ends = np.searchsorted(np.cumsum(self.width[flat]), np.cumsum(widths), "left") + 1
        return flat, np.diff(ends, prepend=0)

    def _forget(self) -> None:
        """Let go of the older half."""
        half = len(self.size) // 2
        keep = self.slots >= half
        self.keys, self.checks, self.slots = self.keys[keep], self.checks[keep], self.slots[keep] - half
        base = int(self.first[half])
        self.flat, self.first, self.size = self.flat[base:].copy(), self.first[half:] - base, self.size[half:].copy()

    def _learn(self, keys: np.ndarray, checks: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Remember chunks in the order of their ids in ``parts``. The older half may go before, never after."""
        flat, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        while len(self.size) > 1 and (len(self.size) + len(keys) > KEPT_CHUNKS or len(self.flat) + len(flat) > KEPT_IDS):
            self._forget()
        n, base = len(self.size), len(self.flat)
        at = np.searchsorted(self.keys, keys)
        order = np.argsort(keys)
        self.slots = np.insert(self.slots, at[order], (n + order).astype(np.int32))
        self.checks = np.insert(self.checks, at[order], checks[order])
        self.keys = np.insert(self.keys, at[order], keys[order])
        self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
        self.first = np.concatenate([self.first, (base + np.cumsum(counts) - counts).astype(np.int32)])
        self.size = np.concatenate([self.size, counts.astype(np.int32)])

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Slots of chunks, -1 for those not known (or known by the first hash only)."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), self.slots[at], -1).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        points, bounds = C.codepoints(texts)
        white = self.white[points]
        white[bounds[1:] - 1] = True  # the end of a text
        spaced = np.zeros(len(points), bool)
        spaced[:-1] = (points[:-1] == 32) & ~white[1:]
        spaced[bounds[1:] - 1] = False
        begins = spaced.copy()
        begins[bounds[:-1][np.diff(bounds) > 1]] = True
        starts = np.flatnonzero(begins)
        owner = np.searchsorted(bounds, starts, "right") - 1
        ends = np.minimum(np.append(starts[1:], len(points)), bounds[owner + 1] - 1)
        hashes, checks = C.span_hashes(points, starts, ends), C.span_hashes(self.other[points], starts, ends)
        keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if (checks[where][inverse] != checks).any():  # two chunks with one hash
            return self._whole(texts)
        slots = self._find(keys, checks[where])
        new = np.flatnonzero(slots < 0)
        if len(new):
            at = where[new]
            new = new[np.argsort(~spaced[starts[at]], kind="stable")]  # those that begin with a space first
            at = where[new]
            found = [texts[o][s - b : e - b] for o, s, e, b in zip(owner[at], starts[at], ends[at], bounds[owner[at]], strict=True)]
            cut = int(spaced[starts[at]].sum())
            total = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])  # UTF-8 bytes
            widths = (total[ends[at]] - total[starts[at]])[:cut]
            self._learn(keys[new], checks[at], [self._spaced(found[:cut], widths), self._whole(found[cut:])])
            slots = self._find(keys, checks[where])
            if (slots < 0).any():  # the block alone has more than is remembered, or chunks with a known one's hash
                return self._whole(texts)
        slots = slots[inverse]
        sizes = self.size[slots].astype(np.int64)
        counts = np.bincount(owner, sizes, len(texts)).astype(np.int64)
        return self.flat[np.repeat(self.first[slots].astype(np.int64), sizes) + C.ramp(sizes)], counts


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (binary, little-endian), n, part (partition) and start (ids before the document within the partition)."""
    schema = "doc_id long, ids binary, n long, part int, start long"

    def run(batches):
        enc, at, part = encoder(path), 0, TaskContext.get().partitionId()
        for rows, texts in C.text_blocks(batches):
            ids, counts = enc.encode(texts)
            ends = np.cumsum(counts)
            made = [ids[e - n : e].tobytes() + np.array([end_id], enc.dtype).tobytes() for e, n in zip(ends, counts, strict=True)]
            n = counts + 1
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(made, pa.binary()), pa.array(n), pa.array(np.full(len(n), part, np.int32)), pa.array(starts)],
                names=["doc_id", "ids", "n", "part", "start"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def cut(tokens: DataFrame, wide: bool, window: int = WINDOW) -> DataFrame:
    """Pieces of the tokenized documents, which must be a written table: its partition totals become global offsets."""
    spark = tokens.sparkSession
    totals = sorted(tokens.groupBy("part").agg(F.sum("n")).collect())  # a row per partition of the first pass
    base = np.zeros(totals[-1][0] + 2 if totals else 1, np.int64)
    for part, n in totals:
        base[part + 1] = n
    kept = spark.sparkContext.broadcast(np.cumsum(base))  # eight bytes per partition
    dtype = "<u4" if wide else "<u2"
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(batches):
        for b in batches:
            n, at = b.column("n").to_numpy(), kept.value[b.column("part").to_numpy()] + b.column("start").to_numpy()
            doc_ids, crc, from_, ends, rows = b.column("doc_id"), [], [], [], []
            for i, (raw, g, count) in enumerate(zip(b.column("ids"), at, n, strict=True)):
                ids = np.frombuffer(raw.as_buffer(), dtype).astype("<u4")
                inner = range(int(window - g % window), int(count), window)
                for s, e in pairwise([0, *inner, int(count)]):
                    rows.append(i)
                    from_.append(s)
                    ends.append(e)
                    crc.append(zlib.crc32(ids[s:e]))
            rows, from_, ends = (np.array(x, np.int64) for x in (rows, from_, ends))
            glob = at[rows] + from_
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(rows)), pa.array(from_), pa.array(ends - from_), pa.array(crc, pa.int64()), pa.array(n[rows]), pa.array(glob // window), pa.array(glob % window)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return tokens.select("doc_id", "ids", "n", "part", "start").mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in windows of ``window`` ids, by the tokenizer file at ``path`` (found there on every executor)."""
    return cut(C.settle(tokenize(docs, path, end_id)), encoder(path).dtype.itemsize == 4, window)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
