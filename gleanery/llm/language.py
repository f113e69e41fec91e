"""Language by a byte convolutional network.

Bytes have learned vectors; filters of several widths run over them, the largest response of each within a window is kept, and
a softmax layer reads those. Everything is trained in numpy on windows of a bounded sample of labelled documents (``FIT_ROWS``
documents, ``FIT_WINDOWS`` windows of each, drawn over the whole text on the executors). For scoring, filters are folded into
tables over bytes and byte pairs, and a text is read whole, in batches of windows of ``WINDOW`` bytes; probabilities are
averaged over its windows by their bytes.

Null texts and texts without a letter are ``und`` with score 0; so is everything if there is nothing to learn from. Repeated
rows are scored each. If two languages tie, the first in order of name is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

WINDOW = 192
FIT_ROWS = 4000
FIT_WINDOWS = 4
WIDTHS = (2, 3, 4)
FILTERS = 8
DIM = 8
BATCH = 256  # windows scored together
UNKNOWN = "und"


def windows(raw: bytes) -> np.ndarray:
    """A text's bytes in rows of WINDOW, the last one filled up with zeros."""
    rows = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(rows, WINDOW)


class Network:
    def __init__(self, langs: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.e = rng.standard_normal((256, DIM)).astype(np.float32) * 0.3
        self.e[0] = 0
        self.k = {w: rng.standard_normal((w * DIM, FILTERS)).astype(np.float32) * (2 / (w * DIM)) ** 0.5 for w in WIDTHS}
        self.kb = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = rng.standard_normal((FILTERS * len(WIDTHS), len(langs))).astype(np.float32) * 0.1
        self.b = np.zeros(len(langs), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, size: int = 64, rate: float = 0.02, seed: int = 2) -> Network:
        """Gradient steps scaled per parameter; only the place of a filter's largest response hands its gradient on."""
        rng = np.random.default_rng(seed)
        params = [self.e, self.out, self.b, *self.k.values(), *self.kb.values()]
        squares = [np.full_like(p, 1e-8) for p in params]
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // size)):
                xb, n = x[at], len(at)
                emb, pooled, kept = self.e[xb], [], {}
                for w in WIDTHS:
                    cols = np.concatenate([emb[:, i : WINDOW - w + 1 + i] for i in range(w)], 2)
                    z = cols @ self.k[w]
                    top = z.argmax(1)
                    pooled.append(np.take_along_axis(z, top[:, None], 1)[:, 0] + self.kb[w])
                    kept[w] = top
                h = np.concatenate(pooled, 1)
                act = np.maximum(h, 0)
                z = act @ self.out + self.b
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(n), y[at]] -= 1
                p /= n
                ge, gk, gkb = np.zeros_like(self.e), [], []
                gh = (p @ self.out.T) * (h > 0)
                for j, w in enumerate(WIDTHS):
                    g, top = gh[:, j * FILTERS : (j + 1) * FILTERS], kept[w]
                    byte = np.stack([np.take_along_axis(xb, top + i, 1) for i in range(w)], 2)  # texts x filters x width
                    vec = self.e[byte].reshape(n, FILTERS, w * DIM)
                    gk.append(np.einsum("nf,nfd->df", g, vec))
                    gkb.append(g.sum(0))
                    back = (g[:, :, None] * self.k[w].T[None]).reshape(n, FILTERS, w, DIM)
                    np.add.at(ge, byte, back)
                ge[0] = 0
                for param, square, grad in zip(params, squares, [ge, act.T @ p, p.sum(0), *gk, *gkb], strict=True):
                    square += grad * grad
                    param -= rate * (1 - 0.8 * epoch / epochs) * grad / np.sqrt(square)
        return self

    def tables(self) -> Network:
        """Fold vectors and filters: the response of a filter is a sum of a byte-pair table for every two bytes and a byte table for an odd one."""
        self.folded = {}
        for w in WIDTHS:
            single = [(self.e @ self.k[w][i * DIM : (i + 1) * DIM]).astype(np.float32) for i in range(w)]
            pairs = [(single[i][None, :, :] + single[i + 1][:, None, :]).reshape(65536, FILTERS) for i in range(0, w - 1, 2)]  # low byte first
            self.folded[w] = (pairs, single[w - 1] if w % 2 else None)
        return self

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), len(self.langs)))
        for s in range(0, len(rows), BATCH):
            x = rows[s : s + BATCH]
            pair = x[:, :-1].astype(np.uint16) | (x[:, 1:].astype(np.uint16) << 8)
            pooled = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                pairs, odd = self.folded[w]
                z = pairs[0][pair[:, :n]]
                for i, t in enumerate(pairs[1:], 1):
                    z += t[pair[:, 2 * i : 2 * i + n]]
                if odd is not None:
                    z += odd[x[:, w - 1 : w - 1 + n]]
                pooled.append(z.max(1) + self.kb[w])
            z = np.maximum(np.concatenate(pooled, 1), 0) @ self.out + self.b
            p = np.exp(z - z.max(1, keepdims=True))
            out[s : s + BATCH] = p / p.sum(1, keepdims=True)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        own = [i for i, t in enumerate(texts) if self.langs and any(map(str.isalpha, t))]
        if own:
            rows = [windows(texts[i].encode("utf-8", "surrogatepass")) for i in own]
            n = np.array([len(r) for r in rows])
            p = np.zeros((len(own), len(self.langs)))
            stacked = np.concatenate(rows)
            weight = np.count_nonzero(stacked, axis=1) + 1e-9
            every = self.probabilities(stacked) * weight[:, None]
            total = C.group_sums(weight, n)
            for j in range(len(self.langs)):
                p[:, j] = C.group_sums(every[:, j], n) / total
            for i, best, q in zip(own, p.argmax(1), p.max(1), strict=True):
                langs[i], score[i] = self.langs[best], min(1.0, max(0.0, q))
        return langs, score


def _training_rows(texts: list[str], part: pa.RecordBatch) -> dict:
    made = []
    for t, d in zip(texts, part.column("doc_id").to_pylist(), strict=True):
        rows = windows(t.encode("utf-8", "surrogatepass"))
        made.append(rows[C.draw(np.arange(len(rows)), FIT_WINDOWS, d)].tobytes())
    return {"windows": pa.array(made, pa.binary())}


def fit(docs: DataFrame, learn, rows: int = FIT_ROWS) -> Network:
    """Learn from at most ``rows`` documents with a lang for which the column ``learn`` holds: the driver gets rows x FIT_WINDOWS windows."""
    keys = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull()).join(F.broadcast(keys.distinct()), "doc_id")
    got = C.map_texts(sample, "doc_id long, lang string, windows binary", _training_rows).toArrow().sort_by([("doc_id", "ascending")])
    langs = sorted(set(got.column("lang").to_pylist()))
    x = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for w in got.column("windows").to_pylist()]
    net = Network(langs)
    if len(langs) > 1:
        y = np.repeat([langs.index(v) for v in got.column("lang").to_pylist()], [len(r) for r in x])
        net.fit(np.concatenate(x), y)
    return net.tables()


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred and score of every document. The network shipped to the tasks has a fixed size."""
    kept = docs.sparkSession.sparkContext.broadcast(net)

    def run(texts, part):
        langs, score = kept.value.predict(texts)
        return {"lang_pred": langs, "score": score}

    return C.map_texts(docs.select("doc_id", "text"), "doc_id long, lang_pred string, score double", run)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    held = C.crc_fold(F.col("doc_id"), 5) == 0
    return predict(docs, fit(docs, ~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
