"""Near-duplicates by DartMinHash signatures and a banded join.

A document is a weighted set: its five-word shingles, each with the number of its places. Similarity is the weighted Jaccard
index, sum of minima over sum of maxima. For a signature, darts are thrown at the area that each element covers (its weight
along one axis, a rank along the other): unit cells get a hashed, Poisson distributed number of darts at hashed places, the same
for the same element in every document. A dart counts if it lies within the element's weight and under the document's rank
limit, which is chosen so that some ``k (ln k + 2)`` darts count in all, however many elements there are; each belongs to a
hashed coordinate, and the earliest of a coordinate is its signature. Two signatures agree in a coordinate with a chance that
equals the similarity. If a coordinate stays empty, the limit is doubled.

Steps: (1) texts with equal weighted sets are one class from the start, told by a 128-bit sum and the number of shingles. (2) Each
distinct text is filed under ``BANDS`` bands of ``ROWS`` coordinates (a pair of similarity 0.8 is missed with a chance of 2e-5).
(3) In a bucket every text is compared with the bucket's first one, a star instead of all pairs. (4) In buckets that still hold
several classes, all texts of different classes are compared, but within tasks: a text is a member of one place, visits the places of the
texts that it shares a bucket with, and only links leave the task, one for each class that is joined. Signatures decide before texts do:
four bits of each coordinate let only those pairs through that may reach the threshold (a true pair is held back with a
chance of 3e-5; one of similarity 0.67 passes in one of a hundred cases), the closest first, and pairs of classes that are joined by
then are left out. So no link between classes that a bucket shows is lost, and rows follow the number of texts, not of pairs. All links
are verified on the whole texts; their components are the classes.

Null, empty and word-free texts have no shingles: each row is a class of its own. Texts of one to four words are one shingle.
Rows with the same id are one document. Rows without an id are left out of the classes; ``keep_one`` tells rows by id and text, and
treats a row without an id like others. Texts of any length are taken whole; one is held in a task at a time.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C
from gleanery.llm.components import components

SIMILAR = 0.8
BANDS = 60
ROWS = 8
WIDTH = BANDS * ROWS
BITS = 4  # of each coordinate in a sketch
SKETCH = -(-WIDTH * BITS // 64)
PLACE = 1 << 19  # shingles of the members of a place, and of the visitors of a chunk
# Agreeing coordinates that a pair of the least similarity has, less four standard deviations (by chance one of 16 of the rest agrees).
_AGREE = SIMILAR + (1 - SIMILAR) / (1 << BITS)
LEAST_SAME = math.floor(WIDTH * _AGREE - 4 * math.sqrt(WIDTH * _AGREE * (1 - _AGREE)))
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, k: int = WIDTH) -> np.ndarray:
    """DartMinHash of weighted sets given one after another (elements distinct within a set, weights over 0): sets x k, zeros for an empty set."""
    out = np.zeros((len(counts), k), np.uint64)
    total = C.group_sums(weights, counts)
    todo = np.flatnonzero(total > 0)
    limit = np.zeros(len(counts))
    limit[todo] = k * (math.log(k) + 2) / total[todo]
    first = np.cumsum(counts) - counts
    whole = bool((weights == np.floor(weights)).all())
    while len(todo):
        n = counts[todo]
        at = np.repeat(first[todo], n) + C.ramp(n)
        owner = np.repeat(np.arange(len(todo)), n)
        ranks = np.ceil(limit[todo]).astype(np.int64)[owner]
        weight, element = weights[at], elements[at]
        cells = np.ceil(weight).astype(np.int64) * ranks
        of = np.repeat(np.arange(len(at)), cells)
        strip, rank = np.divmod(C.ramp(cells), ranks[of])
        seed = C.mix(element[of] + np.uint64(0x9E3779B97F4A7C15) * C.mix((strip.astype(np.uint64) << np.uint64(32)) ^ rank.astype(np.uint64)))
        darts = np.searchsorted(POISSON, _unit(seed), "right")
        some = np.flatnonzero(darts)
        darts = darts[some]
        hit = np.repeat(some, darts)
        dart = C.mix(seed[hit] + np.uint64(0xD1B54A32D192ED03) * (C.ramp(darts) + 1).astype(np.uint64))
        when = rank[hit] + _unit(C.mix(dart ^ np.uint64(0x14057B7EF767814F)))
        of = of[hit]
        doc = owner[of]
        keep = when <= limit[todo][doc]
        if not whole:  # under a whole weight every strip is whole, and so is every dart's height within it
            keep &= strip[hit] + _unit(C.mix(dart ^ np.uint64(0x5851F42D4C957F2D))) <= weight[of]
        doc, dart, when = doc[keep], dart[keep], when[keep]
        slot = doc * k + (C.mix(dart ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(k)).astype(np.int64)
        earliest = np.full(len(todo) * k, np.inf)
        np.minimum.at(earliest, slot, when)
        best = when == earliest[slot]  # of darts at one time the least
        flat = np.full(len(todo) * k, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(flat, slot[best], dart[best])
        done = np.isfinite(earliest).reshape(len(todo), k).all(1)
        out[todo[done]] = flat.reshape(len(todo), k)[done]
        todo = todo[~done]
        limit[todo] *= 2
    return out


def weighted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their numbers of places, and how many distinct ones each text has."""
    values, counts = C.shingles(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])]) if len(v) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return v[at], np.diff(np.append(at, len(v))).astype(np.float64), np.bincount(o[at], minlength=len(texts)).astype(np.int64)


def _sign(texts: list[str], part: pa.RecordBatch) -> dict:
    elements, weights, counts = weighted(texts)
    sig = np.concatenate([signatures(*chunk) for chunk in _chunks(elements, weights, counts)]) if len(texts) else np.zeros((0, WIDTH), np.uint64)
    bands = np.zeros((len(texts), BANDS), np.uint64)
    for r in range(ROWS):
        bands = C.mix(bands * np.uint64(C.BASE) + sig[:, r::ROWS])
    bands = C.mix(bands + np.arange(BANDS, dtype=np.uint64))
    nibbles = (sig & np.uint64(15)).astype(np.uint8)
    sketch = np.ascontiguousarray(nibbles[:, ::2] | (nibbles[:, 1::2] << 4)).view("<i8").reshape(len(texts), SKETCH)
    units = C.mix(elements)
    wide = weights.astype(np.uint64)
    ends = np.cumsum(counts)
    sums = []
    for v in (units * wide, C.mix(units) * wide):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)])
        sums.append((total[ends] - total[ends - counts]).view(np.int64))
    n = C.group_sums(weights, counts).astype(np.int64)
    return {
        "f0": sums[0], "f1": sums[1], "n": n,
        "bands": C.lists(bands.view(np.int64).ravel(), np.full(len(texts), BANDS), pa.int64()),
        "sketch": C.lists(sketch.ravel(), np.full(len(texts), SKETCH), pa.int64()),
    }


def _chunks(elements, weights, counts, cells: int = 150_000):
    """A few sets at a time: a set throws about as many darts as its weight and the limit ask for."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    cost = np.cumsum(C.group_sums(weights, counts) + WIDTH * (math.log(WIDTH) + 2)) // cells
    starts = np.flatnonzero(np.concatenate([[True], np.diff(cost) > 0])) if len(counts) else np.zeros(0, np.int64)
    for i, j in zip(starts, np.append(starts[1:], len(counts)), strict=True):
        yield elements[ends[i] : ends[j]], weights[ends[i] : ends[j]], counts[i:j]


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two sets (sorted elements, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low)) if len(a[0]) or len(b[0]) else 0.0


def verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of ids whose whole texts are similar. Each text moves to the pairs it is in; a is best the one of more pairs."""
    mine = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = mine.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        last, left = None, None  # pairs of a come one after another
        for part, _ in C.text_blocks(batches, "text_b"):
            a, b = part.column("text_a").to_pylist(), part.column("text_b").to_pylist()
            e, w, n = weighted(b)
            ends, keep = np.cumsum(n), []
            for x, end, m in zip(a, ends, n, strict=True):
                if x != last:
                    last, left = x, weighted([x])[:2]
                keep.append(jaccard(left, (e[end - m : end], w[end - m : end])) >= similar - 1e-12)
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, text_id (the least id of the documents with the same shingles) and class_id (the least id of the class)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null")
    signed = C.settle(C.map_texts(docs, "doc_id long, f0 long, f1 long, n long, bands array<long>, sketch array<long>", _sign))
    same = ["f0", "f1", "n"]
    first = signed.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("text_id"))
    rows = signed.select("doc_id", *same).join(first, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("text_id", "doc_id").alias("text_id"))
    rows = C.settle(rows.dropDuplicates(["doc_id"]))

    texts = signed.filter("n > 0").join(rows.filter("doc_id = text_id").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    filed = texts.select("doc_id", F.explode("bands").alias("bucket"))
    shared = filed.groupBy("bucket").agg(F.min("doc_id").alias("head"), F.count("*").alias("size")).filter("size > 1").select("bucket", "head")
    filed = C.settle(filed.join(shared, "bucket"))
    pool = C.settle(docs.join(filed.select("doc_id").distinct(), "doc_id", "left_semi"))
    tried = C.settle(filed.filter("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct())
    root = components(C.settle(verified(tried, pool, similar)))
    filed = filed.select("bucket", "doc_id")
    placed = C.settle(filed.join(root.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("root", "doc_id").alias("class")))
    several = placed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("size")).filter("low < high").select("bucket", "size")
    mixed = C.settle(placed.join(several, "bucket"))
    if not mixed.isEmpty():
        found = C.settle(_within(mixed, texts.select("doc_id", "sketch", F.col("n").alias("weight")), pool, similar))
        if not found.isEmpty():
            root = components(root.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(found))
    return rows.join(root.withColumnRenamed("node", "text_id"), "text_id", "left").select("doc_id", "n_shingles", "text_id", F.coalesce("root", "text_id").alias("class_id"))


def _within(mixed: DataFrame, texts: DataFrame, pool: DataFrame, similar: float) -> DataFrame:
    """Links a, b between texts of different classes that share a bucket of ``mixed`` (bucket, doc_id, class, size of the bucket).

    Texts that buckets connect are a family. A text is a member of one place: its family in order of each text's largest bucket, cut at
    ``PLACE`` shingles, so that a bucket lies in few places however many buckets a family has. It visits the places of all texts that it
    shares a bucket with, and visitors of a place come in chunks of ``PLACE`` shingles. So a text moves to a few places, not to its
    pairs, a task holds two bounded loads, and pairs exist within tasks only."""
    least = mixed.groupBy("bucket").agg(F.min("doc_id").alias("a"))
    family = components(mixed.join(least, "bucket").select("a", F.col("doc_id").alias("b"))).withColumnRenamed("node", "doc_id")
    home = mixed.groupBy("doc_id").agg(F.first("class").alias("class"), F.max_by("bucket", F.struct("size", "bucket")).alias("along"))
    home = home.join(family, "doc_id", "left").withColumn("home", F.coalesce("root", "doc_id")).drop("root")
    home = C.settle(home.join(texts.select("doc_id", "weight"), "doc_id"))
    members = C.settle(C.loads(home.select("doc_id", "home", "along", "weight"), ["home"], ["along", "doc_id"], "place", PLACE))
    here = mixed.join(members.select("doc_id", "home", "place"), "doc_id")
    places = here.groupBy("bucket", "home", "place").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    other = (F.col("low") != F.col("class")) | (F.col("high") != F.col("class"))
    visits = mixed.join(places, "bucket").filter(other).select("doc_id", "home", "place").distinct()
    visits = C.settle(C.loads(visits.join(texts.select("doc_id", "weight"), "doc_id"), ["home", "place"], ["doc_id"], "chunk", PLACE))
    chunks = visits.groupBy("home", "place").agg(F.max("chunk").alias("most"))
    hosts = members.join(chunks, ["home", "place"]).select("doc_id", "home", "place", F.explode(F.sequence(F.lit(0), "most")).alias("chunk"), F.lit(True).alias("member"))
    both = hosts.unionByName(visits.select("doc_id", "home", "place", "chunk", F.lit(False).alias("member")))
    whole = C.settle(home.select("doc_id", "class").join(texts.select("doc_id", "sketch"), "doc_id"))
    both = both.join(whole, "doc_id").join(pool, "doc_id")
    return both.groupBy("home", "place", "chunk").applyInArrow(_compare(similar), "a long, b long").distinct()


def _nibbles(lists: pa.ListArray) -> np.ndarray:
    """A sketch's coordinates, four bits each, as bytes."""
    packed = lists.flatten().to_numpy().view(np.uint8).reshape(-1, WIDTH // 2)
    out = np.empty((len(packed), WIDTH), np.uint8)
    out[:, ::2], out[:, 1::2] = packed & 15, packed >> 4
    return out


def _compare(similar: float):
    def run(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy()
        ids, classes_ = table.column("doc_id").to_numpy(), table.column("class").to_numpy()
        sketch = _nibbles(table.column("sketch").combine_chunks())
        hosts, guests = np.flatnonzero(member), np.flatnonzero(~member)
        left, right, same = [], [], []
        for g in guests:  # a text against all members: signatures decide which pairs may be similar
            agree = (sketch[hosts] == sketch[g]).sum(1)
            near = np.flatnonzero((agree >= LEAST_SAME) & (classes_[hosts] != classes_[g]))
            left.append(np.full(len(near), g))
            right.append(hosts[near])
            same.append(agree[near])
        none = np.zeros(0, np.int64)
        left, right, same = (np.concatenate([none, *x]) for x in (left, right, same))
        texts, sets = table.column("text"), {}

        def of(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in sets:
                sets[i] = weighted([texts[i].as_py()])[:2]
            return sets[i]

        up = {c: c for c in classes_.tolist()}  # classes that are found to be one

        def top(c: int) -> int:
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        a, b = [], []
        for k in np.argsort(-same, kind="stable").tolist():  # the closest first: what they link need not be compared again
            x, y = int(left[k]), int(right[k])
            cx, cy = top(int(classes_[x])), top(int(classes_[y]))
            if cx != cy and jaccard(of(x), of(y)) >= similar - 1e-12:
                up[cx] = cy
                a.append(min(ids[x], ids[y]))
                b.append(max(ids[x], ids[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """docs with exactly one row for each class: the one of the least id. Rows are told by id and text together, so a text that shares
    its id with a copy is not taken for it, rows without an id are classed by their texts, and a row repeated whole stays once."""
    row = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))
    keyed = docs.select(row.alias("row"), "doc_id", "text")
    place = classes(keyed.select(F.col("row").alias("doc_id"), "text"), similar).select(F.col("doc_id").alias("row"), "class_id")
    ids = keyed.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    best = F.min_by(F.struct("row", "copies"), F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    stay = C.settle(place.join(ids, "row").groupBy("class_id").agg(best).select("best.*"))
    # Texts are shuffled for it at any size, so that what a small table costs tells what a large one will.
    kept = docs.withColumn("_row", row).join(stay.select(F.col("row").alias("_row")).hint("merge"), "_row", "left_semi")
    if stay.filter("copies > 1").isEmpty():
        return kept.select(docs.columns)
    alone, again = (stay.filter(c).select(F.col("row").alias("_row")) for c in ("copies = 1", "copies > 1"))
    kept = kept.select("_row", *docs.columns)
    return kept.join(alone, "_row", "left_semi").unionByName(kept.join(again, "_row", "left_semi").dropDuplicates(["_row"])).select(docs.columns)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(C.table(spark, sf_dir, "documents"))


# Without signatures: all shingles joined, and components by closure.
ORACLE = f"""
WITH RECURSIVE d AS ({C.SQL_WORDS.format(id="doc_id", table="documents")}), tokens AS (SELECT r, g, count(*) AS c FROM (SELECT r, hash(unnest({C.SQL_SHINGLES})) AS g FROM d WHERE len(w) > 0) GROUP BY ALL),
n AS (SELECT d.r, doc_id, CAST(coalesce(sum(c), 0) AS BIGINT) AS n FROM d LEFT JOIN tokens USING (r) GROUP BY d.r, doc_id),
common AS MATERIALIZED (SELECT a.r AS x, b.r AS y, sum(least(a.c, b.c)) AS m FROM tokens a JOIN tokens b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
pairs AS (SELECT x, y, m = a.n AND m = b.n AS equal FROM common JOIN n a ON x = a.r JOIN n b ON y = b.r WHERE 5 * m >= 4 * (a.n + b.n - m)),
links AS MATERIALIZED (SELECT * FROM pairs UNION ALL SELECT y, x, equal FROM pairs),
reach AS (SELECT r AS x, r AS y FROM n UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
same AS (SELECT x, min(doc_id) AS least FROM links JOIN n ON y = r WHERE equal GROUP BY x)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, any_value(same.least)) AS text_id, min(other.doc_id) AS class_id
FROM n JOIN reach ON n.r = reach.x JOIN n other ON reach.y = other.r LEFT JOIN same ON same.x = n.r GROUP BY n.r, n.doc_id, n.n
"""
