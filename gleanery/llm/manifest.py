"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

A row's leaf is the hash of its columns, each as ``-`` (null) or ``<bytes>:<value>``. The leaves of a group, in order of their
id, are hashed two by two, level by level, to the group's subroot (a last node alone is hashed alone); the subroots, in order of
the group, likewise to the root. Positions come from exact distributed ranks. ``STRIDE`` levels are built at a time from runs of
2**STRIDE neighbours, so no group is gathered whole and a billion rows take four rounds.

Proofs: every node holds the sibling entry that leads to its parent. A round joins each node to the node its entries lead to
and concatenates both segments, which doubles the distance: after log2(depth) self-joins every leaf has all entries up to its
subroot, and those of the subroots, found the same way, are concatenated. Nodes that no leaf will land on any more are left
out of each round. Late rounds have few ancestors for many leaves: one row for each ancestor on the right, so Spark broadcasts
that side if it is small and else splits the left one (adaptive skew join).

Rows of equal id are ordered by their leaf; a null id comes first, and so does a null group. Repeated rows are leaves each. An
empty table has no rows, and no root. Texts of any length are hashed in one pass; columns of other names are not read. A
lone leaf is its subroot, a lone subroot the root; the proof of a lone leaf of a lone group is the hash of nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C
from gleanery.operators import ordered

STRIDE = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<binary>"  # entries level by level: L or R and the sibling's 32 bytes, empty where there is no sibling


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def _parents(level: Column) -> Column:
    """Hashes of every two neighbours of an array of hex digests."""

    def parent(i: Column) -> Column:
        return F.sha2(F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256)

    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(level) / 2).cast("int") - 1), parent)


def _entries(level: Column) -> Column:
    """Each node's sibling entry. Runs start at even positions, so parity within the run is parity in the tree."""

    def entry(i: Column) -> Column:
        left = F.concat(F.encode(F.lit("L"), "utf-8"), F.unhex(F.get(level, i - 1)))
        right = F.concat(F.encode(F.lit("R"), "utf-8"), F.unhex(F.get(level, i + 1)))
        return F.when(i % 2 == 1, left).otherwise(F.coalesce(right, F.encode(F.lit(""), "utf-8")))

    return F.transform(F.sequence(F.lit(0), F.size(level) - 1), entry)


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Trees over leaves (tree, pos from 0, digest): nodes below the roots (tree, level, idx, seg), roots (tree, digest), and the greatest depth."""
    sizes = leaves.groupBy("tree").agg((F.max("pos") + 1).alias("n"))
    # Halving with rounding up: as many levels as n - 1 has binary digits.
    depths = C.settle(sizes.select("tree", F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1))).cast("int").alias("depth")))
    deepest = depths.agg(F.max("depth")).first()[0] or 0
    roots = [leaves.join(depths.filter("depth = 0"), "tree").select("tree", "digest")]
    nodes, level, base = [], leaves.select("tree", "pos", "digest"), 0
    while base < deepest:
        step = min(STRIDE, deepest - base)
        runs = level.groupBy("tree", F.shiftright("pos", step).alias("run")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "digest"))), lambda s: s["digest"]).alias("l0"))
        for j in range(step):
            runs = runs.withColumn(f"l{j + 1}", _parents(F.col(f"l{j}")))
        runs = C.settle(runs.join(depths.filter(F.col("depth") > base), "tree"))
        for j in range(step):
            own = runs.filter(F.col("depth") > base + j).select("tree", "run", F.posexplode(_entries(F.col(f"l{j}"))).alias("i", "entry"))
            nodes.append(own.select("tree", F.lit(base + j).alias("level"), (F.shiftleft("run", step - j) + F.col("i")).alias("idx"), F.array("entry").alias("seg")))
            roots.append(runs.filter(F.col("depth") == base + j + 1).select("tree", F.get(f"l{j + 1}", F.lit(0)).alias("digest")))
        level = runs.filter(F.col("depth") > base + step).select("tree", F.col("run").alias("pos"), F.get(f"l{step}", F.lit(0)).alias("digest"))
        base += step
    if not nodes:
        nodes = [leaves.filter("false").select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.lit(None).cast(SEGMENT).alias("seg"))]
    return reduce(DataFrame.unionAll, nodes), C.settle(reduce(DataFrame.unionAll, roots)), deepest


def proofs(nodes: DataFrame, deepest: int) -> DataFrame:
    """tree, pos and the whole segment (``seg``) of every leaf that is not a root, by pointer jumping."""
    step = 1
    while step < deepest:
        left = nodes.filter(F.col("level") % (2 * step) == 0)
        right = nodes.filter(F.col("level") % (2 * step) == step).select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("x"), F.col("seg").alias("further"))
        there = (F.col("tree") == F.col("t")) & (F.col("level") + step == F.col("l")) & (F.shiftright("idx", step) == F.col("x"))
        nodes = C.settle(left.join(right, there, "left").select("tree", "level", "idx", F.concat("seg", F.coalesce("further", F.array().cast(SEGMENT))).alias("seg")))
        step *= 2
    return nodes.filter("level = 0").select("tree", F.col("idx").alias("pos"), "seg")


def siblings(segment: Column) -> Column:
    """The siblings of a segment as hex text, one after another."""
    return F.array_join(F.transform(segment, lambda e: F.lower(F.hex(F.substring(e, 2, 32)))), "")


def fold(leaf_digest: Column, segment: Column) -> Column:
    """The root that a leaf and the entries of its proof lead to."""

    def up(digest: Column, entry: Column) -> Column:
        other = F.lower(F.hex(F.substring(entry, 2, 32)))
        left = F.substring(entry, 1, 1) == F.encode(F.lit("L"), "utf-8")
        return F.sha2(F.when(F.octet_length(entry) == 0, digest).when(left, F.concat(other, digest)).otherwise(F.concat(digest, other)), 256)

    return F.aggregate(segment, leaf_digest, up)


def manifest(rows: DataFrame, group: str, order: str) -> DataFrame:
    """rows (with ``leaf``, a hex digest) with subroot, root and ``proof``, the segment from the leaf to the root.

    Rows should be narrow: they are written twice and ordered once.
    """
    kept = rows.columns
    # A number for every row: equal rows are leaves each, and need a total order.
    rows = C.settle(rows.withColumn("_row", F.monotonically_increasing_id()))
    ranked = ordered.rank(ordered.blocks(rows.select(group, order, "leaf", "_row"), [group], [order, "leaf", "_row"])).rows
    trees = C.settle(ordered.rank(ordered.blocks(rows.select(group).distinct(), [], [group])).rows.select(F.col(group).alias("_g"), (F.col("rn") - 1).alias("tree")))
    placed = C.settle(
        ranked.join(trees, ranked[group].eqNullSafe(trees["_g"])).select("_row", "tree", (F.col("rn") - 1).alias("pos"), F.col("leaf").alias("digest"))
    )
    nodes, subroots, deepest = build(placed.select("tree", "pos", "digest"))
    below = proofs(nodes, deepest)
    tops, root, height = build(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "digest"))
    above = subroots.join(proofs(tops, height).select(F.col("pos").alias("tree"), F.col("seg").alias("above")), "tree", "left")
    above = above.crossJoin(F.broadcast(root.select(F.col("digest").alias("root"))))  # one row: the root
    above = C.settle(above.select("tree", F.col("digest").alias("subroot"), "root", F.coalesce("above", F.array().cast(SEGMENT)).alias("above")))
    whole = placed.join(below, ["tree", "pos"], "left").join(above, "tree")
    whole = whole.select("_row", "subroot", "root", F.concat(F.coalesce("seg", F.array().cast(SEGMENT)), "above").alias("proof"))
    return rows.join(whole, "_row").select(*kept, "subroot", "root", "proof")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in FIELDS]
    altered = leaf([(F.col(c) + 1) if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = C.crc_fold(F.col("doc_id"), 7) == 0
    rows = docs.select("doc_id", "lang", leaf(fields).alias("leaf"), F.when(hit, altered).alias("altered"))
    done = manifest(rows, "lang", "doc_id")
    folded = fold(F.coalesce("altered", "leaf"), F.col("proof"))
    return done.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELDS = " || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS)
_ALTERED = _FIELDS.replace("CAST(n_chars AS VARCHAR)", "CAST(n_chars + 1 AS VARCHAR)")


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string in SQL: bit by bit, as DuckDB has none."""
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = "xor(c, d)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: {bit})[1]"
    digits = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, d: {step}), 4294967295)"


ORACLE = f"""
WITH RECURSIVE docs AS (SELECT *, sha256({_FIELDS}) AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN sha256({_ALTERED}) ELSE sha256({_FIELDS}) END AS shown FROM documents),
placed AS (SELECT doc_id, lang, leaf, shown, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
levels AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS l FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, list_transform(range((len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM levels WHERE len(l) > 1
),
subroots AS (SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS nth FROM levels WHERE len(l) = 1),
tops AS (
  SELECT 0 AS lvl, list(subroot ORDER BY nth) AS l FROM subroots
  UNION ALL
  SELECT lvl + 1, list_transform(range((len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM tops WHERE len(l) > 1
),
proofs AS (
  SELECT p.doc_id, p.lang, p.leaf, p.pos, p.shown, list(CASE WHEN (p.pos >> v.lvl) & 1 = 1 THEN 'L' || v.l[(p.pos >> v.lvl)] WHEN v.l[(p.pos >> v.lvl) + 2] IS NULL THEN '' ELSE 'R' || v.l[(p.pos >> v.lvl) + 2] END ORDER BY v.lvl) FILTER (len(v.l) > 1) AS own
  FROM placed p JOIN levels v ON p.lang IS NOT DISTINCT FROM v.lang GROUP BY ALL
),
above AS (
  SELECT s.lang, s.subroot, list(CASE WHEN (s.nth >> t.lvl) & 1 = 1 THEN 'L' || t.l[(s.nth >> t.lvl)] WHEN t.l[(s.nth >> t.lvl) + 2] IS NULL THEN '' ELSE 'R' || t.l[(s.nth >> t.lvl) + 2] END ORDER BY t.lvl) FILTER (len(t.l) > 1) AS further
  FROM subroots s CROSS JOIN tops t GROUP BY ALL
),
whole AS (SELECT p.doc_id, p.leaf, p.shown, a.subroot, list_concat(coalesce(p.own, []), coalesce(a.further, [])) AS path, (SELECT l[1] FROM tops WHERE len(l) = 1) AS root FROM proofs p JOIN above a ON p.lang IS NOT DISTINCT FROM a.lang),
folded AS (SELECT *, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, list_reduce(list_prepend(shown, path), lambda a, s: sha256(CASE WHEN s = '' THEN a WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
