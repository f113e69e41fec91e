"""Homomorphic multiset hashes of documents.

A fingerprint is the sum of the vectors of a document's paragraphs, lane by lane, modulo a power of two. Its first
``STRICT`` lanes (modulo 2**32) are hashed from whole paragraphs: documents with the same paragraphs, in any order, are equal
in them. The further 64 lanes (kept modulo 2**16) count set bits in the hashes of the paragraph's sentences, next to the number
of sentences: read as sums of signs they also tell how alike two documents are. All lanes are sums, so a paragraph is inserted
or deleted by adding or taking away its own fingerprint (``add``, ``remove``).

All of it is SQL functions. A null text is an empty one, which has one empty paragraph. Repeated rows (same id and text) get
the same result; the next document of each is the next other row by (doc_id, hash of the text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C
from gleanery.llm.neighbours import with_next

STRICT = 8
LOW = 0xFFFFFFFF


def _total(hashes: Column, part) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: total + part(h)).bitwiseAND(F.lit(LOW))


def _sums(paragraphs: Column) -> list[Column]:
    """STRICT lanes: halves of 64-bit hashes, a seed for every two lanes."""

    def seeded(seed: int) -> Column:
        return F.transform(paragraphs, lambda p: F.xxhash64(p, F.lit(seed)))

    lanes = []
    for hashed in map(seeded, range(STRICT // 2)):
        lanes += [_total(hashed, lambda h: h.bitwiseAND(F.lit(LOW))), _total(hashed, lambda h: F.shiftrightunsigned(h, 32))]
    return lanes


def _bits(hashes: Column) -> list[Column]:
    """For each of 64 bits how many hashes have it; two counters share a sum."""
    mask = F.lit((1 << 32) | 1)

    def counted(bit: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: total + F.shiftrightunsigned(h, bit).bitwiseAND(mask))

    pairs = [counted(bit) for bit in range(32)]
    return [p.bitwiseAND(F.lit(LOW)) for p in pairs] + [F.shiftrightunsigned(p, 32) for p in pairs]


def with_lanes(df: DataFrame, text: str, lanes: str) -> DataFrame:
    """df with the array ``lanes``: strict lanes, the number of sentences, and 64 bit counts."""
    paragraphs = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    sentences = F.flatten(F.transform(F.col("_paragraphs"), lambda p: F.split(p, "(?<=[.!?]) ")))
    hashed = F.transform(F.col("_sentences"), lambda s: F.xxhash64(s))
    return (
        df.withColumn("_paragraphs", paragraphs)
        .withColumn("_sentences", sentences)
        .withColumn("_hashes", hashed)
        .withColumn(lanes, F.array(*_sums(F.col("_paragraphs")), F.size("_hashes").cast("long"), *_bits(F.col("_hashes"))))
        .drop("_paragraphs", "_sentences", "_hashes")
    )


def text_of(lanes: Column) -> Column:
    """The fingerprint as hex digits: eight for a strict lane and the number of sentences, four for a bit count."""
    strict = F.transform(F.slice(lanes, 1, STRICT + 1), lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(LOW))), 8, "0"))
    bits = F.transform(F.slice(lanes, STRICT + 2, 64), lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFF))), 4, "0"))
    return F.lower(F.concat(F.array_join(strict, ""), F.array_join(bits, "")))


def _modulo(i: Column) -> Column:
    return F.when(i <= STRICT, F.lit(LOW)).otherwise(F.lit((1 << 62) - 1))


def add(a: Column, b: Column) -> Column:
    """Lanes of a document to which the paragraphs of b were added."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x, i: (x["a"] + x["b"]).bitwiseAND(_modulo(i)))


def remove(a: Column, b: Column) -> Column:
    """Lanes of a document from which the paragraphs of b were taken."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x, i: (x["a"] - x["b"]).bitwiseAND(_modulo(i)))


def signs(lanes: Column) -> Column:
    """The sign sums of the 64 bit counts: what two documents are compared by."""
    counts = F.slice(lanes, STRICT + 2, 64)
    return F.transform(counts, lambda c: (2 * c - F.element_at(lanes, STRICT + 1)).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from sign sums: twice the common sentences over those of both, as far as 64 signs tell; 1 if all are equal."""

    def product(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda t, p: t + p)

    shared = 2 * product(a, b) / F.nullif(product(a, a) + product(b, b), F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(shared, F.lit(0.0)))))


def edited(docs: DataFrame) -> DataFrame:
    """Each document with its edited text: the last quarter replaced by as much of the start of the next document.

    Columns doc_id, text, n_chars, edited, and next_signs, the sign sums of the next document. Only ids, hashes and lengths are
    ordered. Texts are shuffled once, by id and hash, and read twice from there: to hand their start and signs to the document
    before, and to meet what they are handed themselves.
    """
    first = F.lit(-(1 << 63))  # a null id comes first in the order
    texts = docs.select(F.coalesce("doc_id", first).alias("key"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = texts.select("key", "h", F.char_length("text").alias("n")).groupBy("key", "h", "n").agg(F.count("*").alias("copies"))
    order = C.settle(with_next(rows, ["key", "h"], wrap=True).select("key", "h", "n", "copies", F.struct("next.key", "next.h").alias("next")))
    asked = order.select(F.col("next.key").alias("key"), F.col("next.h").alias("h"), F.col("key").alias("for_key"), F.col("h").alias("for_h"), "n")
    given = texts if order.filter("copies > 1").isEmpty() else texts.dropDuplicates(["key", "h"])
    handed = with_lanes(given.join(asked, ["key", "h"]), "text", "lanes")
    handed = handed.select(F.col("for_key").alias("key"), F.col("for_h").alias("h"), "n", F.expr("left(text, cast(floor(n / 4) as int))").alias("start"), signs(F.col("lanes")).alias("next_signs"))
    kept = F.expr("left(text, cast(n - floor(n / 4) as int))")
    return texts.join(handed, ["key", "h"]).select(F.nullif("key", first).alias("doc_id"), "text", F.col("n").cast("long").alias("n_chars"), F.concat(kept, "start").alias("edited"), "next_signs")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited(C.table(spark, sf_dir, "documents")).withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_lanes(with_lanes(rows, "text", "lanes"), "edited", "edited_lanes")
    rows = rows.withColumns({"own_signs": signs(F.col("lanes")), "edited_signs": signs(F.col("edited_lanes"))})
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        text_of(F.col("lanes")).alias("fingerprint"), text_of(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("own_signs"), F.col("edited_signs")).alias("near_edited"), likeness(F.col("own_signs"), F.col("next_signs")).alias("near_next"),
    )
