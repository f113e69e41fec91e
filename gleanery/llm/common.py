"""What the operators share: tables, shared scratch space, blocks of texts, word hashes, and the samples that models are fitted on."""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from gleanery.operators import ordered

BLOCK_CHARS = 1 << 19  # a block holds whole texts of so many characters together, or one longer text
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _local_scratch() -> str:
    import tempfile

    return tempfile.mkdtemp(prefix="scratch-")


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; where that is unset, in the warehouse, or with one local JVM in a temporary folder."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        alone = spark.sparkContext.master.split("[")[0] == "local"
        top = _local_scratch() if alone else spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write df to shared scratch space and read it back: lineage is cut, lost executors cost nothing, partition ids and random choices are fixed."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(key: Column, folds: int) -> Column:
    return F.crc32(key.cast("string")) % folds


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches and their texts (null: empty), each of at most ``most`` characters together or one row."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start = size = 0
        for i, t in enumerate(texts):
            if i > start and size + len(t) > most:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if len(texts) > start:
            yield batch.slice(start), texts[start:]


def map_texts(df: DataFrame, schema: str | StructType, fn: Callable[[list[str], pa.RecordBatch], dict], column: str = "text") -> DataFrame:
    """Apply fn to blocks of texts. It returns new columns by name; other columns of the schema are taken from the rows."""
    wanted = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for part, texts in text_blocks(batches, column):
            made = fn(texts, part)
            cols = [made[f.name] if f.name in made else part.column(f.name) for f in wanted]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, wanted, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=wanted.names)

    return df.mapInArrow(run, schema)


def scored(docs: DataFrame, fn: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """docs with the column ``score`` made by fn from the texts; a column of that name is replaced."""
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return map_texts(docs, schema, lambda texts, _: {"score": fn(texts)})


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array of lists from their values one after another."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@cache
def word_table() -> np.ndarray:
    """For every code point whether it belongs to a word: letters, marks and digits."""
    return np.fromiter((unicodedata.category(chr(i))[0] in "LMN" for i in range(0x110000)), bool, 0x110000)


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, a zero after each, and where each text starts (with the end as a last entry)."""
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(lens)])


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK_CHARS + 2)
        for name, base in (("up", BASE), ("down", UNBASE)):
            _POWERS[name] = np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, base, U64)]))
    return _POWERS["up"], _POWERS["down"]


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of code points, equal for equal spans wherever they lie."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, U64)
    np.cumsum((points.astype(U64) + U64(1)) * up[: len(points)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and how many each text has."""
    points, bounds = codepoints([t.lower() for t in texts])
    starts, ends = spans(word_table()[points])
    return span_hashes(points, starts, ends), np.diff(np.searchsorted(starts, bounds))


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words in each text, repeats included; a shorter text that has words is one shingle. And their number in each text."""
    w, n = words(texts)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out = np.zeros(int(counts.sum()), U64)
    at = np.repeat(first, counts) + ramp(counts)
    have = np.repeat(n, counts)
    for k in range(size):
        there = have > k
        out[there] += w[at[there] + k] * U64(pow(BASE, k + 1, 1 << 64))
    return mix(out), counts


def ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after another."""
    n = int(counts.sum())
    return np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)


def group_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups (0 for an empty one)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def draw(values: np.ndarray, most: int, doc_id: object) -> np.ndarray:
    """At most ``most`` of the values, drawn by the document's id: the same whatever rows stand around it."""
    if len(values) <= most:
        return values
    seed = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    return np.random.default_rng(seed).choice(values, most, replace=False)


def gathered(rows: DataFrame, *lists: str) -> tuple[np.ndarray, np.ndarray, list[list[tuple[np.ndarray, np.ndarray]]]]:
    """A bounded sample on the driver: the order of its rows by doc_id, their labels in that order, and for each list column
    (values, counts) batch by batch as they came. Arrow's table is let go, so a sample is held once."""
    table = rows.toArrow()
    ids = table.column("doc_id").to_numpy()
    y = table.column("label").to_numpy()
    parts = []
    for name in lists:
        own = []
        for chunk in table.column(name).chunks:
            ends = chunk.offsets.to_numpy()
            own.append((chunk.values.to_numpy()[ends[0] : ends[-1]].copy(), np.diff(ends)))
        parts.append(own)
    order = np.argsort(ids, kind="stable")
    del table
    pa.default_memory_pool().release_unused()
    return order, y[order], parts


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents to learn from: doc_id, text, label. crc32(doc_id) mod 4 = 2 is held out; the choice goes by a hash of the id."""
    keys = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 4) != 2))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(keys), "doc_id")  # at most `rows` short rows


def loads(rows: DataFrame, keys: list[str], order: list[str], name: str, most: int) -> DataFrame:
    """rows with the number of the load they are in: consecutive rows of a key, with ``weight`` of some ``most`` in all."""
    b = ordered.running(ordered.blocks(rows, keys, order), {"_before": ("sum", F.col("weight"))}, inclusive=False)
    return ordered.finish(b).withColumn(name, F.floor(F.col("_before") / most).cast("int")).drop("_before")


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Which of the pairs (of numbers under size) join two components that were apart: hook, then compress, until no pair does."""
    root, kept = np.arange(size), np.zeros(len(a), bool)
    while True:
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = np.flatnonzero(low < high)
        if not len(apart):
            return kept
        _, first = np.unique(high[apart], return_index=True)  # one pair hooks a root
        use = apart[first]
        kept[use] = True
        root[high[use]] = low[use]
        while (root[root] != root).any():
            root = root[root]


# SQL for the same words and five-word shingles: (row, doc or item id, words) of a table.
SQL_WORDS = r"SELECT row_number() OVER () AS r, {id}, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM {table}"
SQL_SHINGLES = "list_transform(range(greatest(1, len(w) - 4)), lambda i: array_to_string(w[i + 1:i + 5], ' '))"
