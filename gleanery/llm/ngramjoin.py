"""Jaccard join of word n-gram sets by prefix trees.

A document is its set of five-word shingles (64-bit hashes). Two sets link when ``100 * common >= similar * union``. Exact:

1. Equal sets are one (told by a 64-bit sum of mixed hashes and their number), with the number of documents that have them.
2. Most sets share too little with any other. The ``k`` prefix filter leaves them out: of the hash-smallest ``n - need + k`` shingles
   of a set, a partner has at least ``k`` among its own. Rows (shingle, set) are sorted in ranges of both, so a frequent shingle is spread
   over tasks; neighbours tell which shingles are shared. Rows at the edge of a range count as shared, which only keeps a set too many.
3. What is left is ordered by the number of sets that have a shingle, rare ones first. Shingles of one set only are a number, no
   longer a list. Linked sets share a shingle of their prefixes, the rarest ``n - need + 1`` (hot passages are hardly ever in one).
4. Each set is a member of one tree: trees are keyed by the least hashed shingle, so most of a family of near copies is in one, and
   a tree of more than ``TREE`` shingles is cut into more along the order of set sizes. A set visits the trees that have
   members with a shingle of its prefix and of a possible size; visitors of a tree are cut into chunks of ``TREE`` shingles too. So
   no task holds more than two such loads, whatever one key weighs.
5. In a task members are stored in a trie, frequent shingles first, so that a family shares its nodes. All visitors go down
   together, each with its overlap so far; a subtree is left when what remains of the visitor, or of the longest set below, can't reach
   the overlap asked for. A visitor meets each set once. Links are counted, not listed: out come the number of linked documents and, of the links,
   a spanning forest, at most one row for each set in the task.

Components of the forests' links give the classes. The number of rows follows the number of documents, also within a
family where all are linked with all.

Null, empty and word-free texts have an empty set and no links. Texts of one to four words are one shingle. Repeated rows are
documents each, equal sets. Rows without an id are counted and linked like others; their component is the least id in it, or null
if none has one. Texts of any length are read whole; a text is held whole in a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C
from gleanery.llm.components import components

SIMILAR = 80  # hundredths
SIZE = 5
TREE = 1 << 20  # shingles of a tree, and of the visitors of a chunk
CELLS = 1 << 24  # of the bitmap of visitors and shingles, and of tests done at once

_LOWER = np.arange(0x110000, dtype=np.uint32)
_LOWER[65:91] += 32


def shingles(texts: list[str], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, rising, and their number. Words lie between ASCII white space; only A-Z are lower-cased."""
    points, bounds = C.codepoints(texts)
    points = _LOWER[points]
    inside = ~((points == 32) | ((points >= 9) & (points <= 13)))
    inside[bounds[1:] - 1] = False
    starts, ends = C.spans(inside)
    w, n = C.span_hashes(points, starts, ends), np.diff(np.searchsorted(starts, bounds))
    first = np.cumsum(n) - n
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    at, have = np.repeat(first, counts) + C.ramp(counts), np.repeat(n, counts)
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = have > k
        h[there] += w[at[there] + k] * np.uint64(pow(C.BASE, k + 1, 1 << 64))
    h = C.mix(h).view(np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((h, owner))
    h = h[order]  # owners rise as before
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)


def _least(n: Column | np.ndarray, similar: int):
    """Fewest shingles of a set of n that a linked one has: ceil(similar n / 100)."""
    return -((-similar * n) // 100)


def _more(n: np.ndarray) -> np.ndarray:
    """k of the prefix filter."""
    return n // 10 + 1


def _signed(similar: int):
    def sign(texts: list[str], part: pa.RecordBatch) -> dict:
        h, n = shingles(texts)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(C.mix(h.view(np.uint64)), dtype=np.uint64)])
        ends = np.cumsum(n)
        take = np.minimum(n, n - _least(n, similar) + _more(n))
        at = np.repeat(ends - n, take) + C.ramp(take)
        return {"set": C.mix(total[ends] - total[ends - n] + n.astype(np.uint64)).view(np.int64), "n": n, "prefix": C.lists(h[at], take, pa.int64())}

    return sign


def _shared(rows: DataFrame) -> DataFrame:
    """set and n of the rows (h, set, n), sorted within the partition, whose h another set has too; once for copies next to each other."""

    def run(batches):
        last = None  # of the rows so far: h, set, n, and whether it was found shared
        for part in batches:
            h, s, n = (part.column(c).to_numpy() for c in ("h", "set", "n"))
            if not len(h):
                continue
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
            if last and last[:2] == (h[0], s[0]):
                new[0] = False
            h, s, n = h[new], s[new], n[new]
            if not len(h):
                continue
            alike = np.concatenate([[False], h[1:] == h[:-1], [False]])
            alike[0] = last is None or last[0] == h[0]  # the first row of a partition counts as shared
            out = alike[:-1] | alike[1:]
            if last and alike[0] and not last[3]:
                yield pa.RecordBatch.from_arrays([pa.array([last[1]], pa.int64()), pa.array([last[2]], pa.int64())], names=["set", "n"])
            own, last = out[:-1], (h[-1], s[-1], n[-1], bool(out[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(s[:-1][own]), pa.array(n[:-1][own])], names=["set", "n"])
            if out[-1]:
                yield pa.RecordBatch.from_arrays([pa.array(s[-1:]), pa.array(n[-1:])], names=["set", "n"])
        if last and not last[3]:  # and so does the last one
            yield pa.RecordBatch.from_arrays([pa.array([last[1]], pa.int64()), pa.array([last[2]], pa.int64())], names=["set", "n"])

    return rows.repartitionByRange("h", "set", "at").sortWithinPartitions("h", "set").select("h", "set", "n").mapInArrow(run, "set long, n long")


def _tokens(texts: list[str], part: pa.RecordBatch) -> dict:
    h, n = shingles(texts)
    return {"h": C.lists(h, n, pa.int64())}


class Trie:
    """Sets of codes (falling frequency first) in a path-compressed trie: node i has the codes flat[start[i]:end[i]] and children first[i]:last[i]."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, n: np.ndarray):
        starts = np.cumsum(counts) - counts
        rows = [codes[s : s + c] for s, c in zip(starts, counts, strict=True)]
        self.order = np.array(sorted(range(len(rows)), key=lambda i: rows[i].tolist()), np.int64)
        sets = [rows[i] for i in self.order]
        n = n[self.order]
        common = np.zeros(len(sets) + 1, np.int64)  # codes shared with the set before
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[i] = differ[0] if len(differ) else m
        flat, start, end, lo, hi, depth, child, few, many, long = [], [], [], [], [], [], [], [], [], []
        at = 0
        level = [(0, len(sets), 0)] if sets else []
        self.roots = (0, 1)
        todo = level
        while todo:  # breadth first: the children of a node come one after another
            following = []
            for a, b, d in todo:
                m = len(sets[a]) if b - a == 1 else int(common[a + 1 : b].min())
                seg = sets[a][d:m]
                flat.append(seg)
                start.append(at)
                at += len(seg)
                end.append(at)
                lo.append(a)
                depth.append(m)
                own = a
                while own < b and len(sets[own]) == m:  # sets that end here
                    own += 1
                hi.append(own)
                few.append(n[a:b].min())
                many.append(n[a:b].max())
                long.append(max(len(x) for x in sets[a:b]) - m)
                cuts = [own, *(own + 1 + np.flatnonzero(common[own + 1 : b] == m)).tolist(), b] if own < b else [b]
                child.append(len(cuts) - 1)
                following += [(x, y, m) for x, y in zip(cuts, cuts[1:])]
            todo = following
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        self.start, self.end, self.lo, self.hi, self.few, self.many, self.long, self.child = (np.array(x, np.int64) for x in (start, end, lo, hi, few, many, long, child))
        self.first = 1 + np.cumsum(self.child) - self.child

    def links(self, codes: np.ndarray, counts: np.ndarray, n: np.ndarray, similar: int) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, member) of all linked pairs of visitors, given like members. ``n`` also counts shingles that have no code."""
        v_found, m_found = [], []
        vocab = int(max(self.flat.max(initial=-1), codes.max(initial=-1))) + 1
        step = max(1, CELLS // max(1, vocab))
        ends = np.cumsum(counts)
        for a in range(0, len(counts), step):
            b = min(a + step, len(counts))
            lo = ends[a] - counts[a]
            own, who = codes[lo : ends[b - 1]], np.repeat(np.arange(b - a), counts[a:b])
            has = np.zeros((b - a, vocab), np.uint8)
            has[who, own] = 1
            order = np.sort(who * vocab + own)
            v, m = self._walk(has, order, ends[a:b] - lo, n[a:b], similar)
            v_found.append(v + a)
            m_found.append(m)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *v_found]), self.order[np.concatenate([none, *m_found])]

    def _walk(self, has, order, ends, n, similar):
        vocab, out_v, out_m = has.shape[1], [], []
        stack = [(np.arange(len(n)), np.zeros(len(n), np.int64), np.zeros(len(n), np.int64))] if len(self.start) else []
        while stack:
            v, node, got = stack.pop()
            width = self.end[node] - self.start[node]
            load = np.cumsum(width + 1)
            if load[-1] > CELLS and len(v) > 1:  # cut the front in two, depth first, so that its memory is bounded
                half = max(1, int(np.searchsorted(load, load[-1] // 2)))
                stack += [(v[half:], node[half:], got[half:]), (v[:half], node[:half], got[:half])]
                continue
            fits = (100 * self.many[node] >= similar * n[v]) & (similar * self.few[node] <= 100 * n[v])
            v, node, got, width = v[fits], node[fits], got[fits], width[fits]
            at = np.repeat(self.start[node], width) + C.ramp(width)
            hits = has[np.repeat(v, width), self.flat[at]]
            total = np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])
            stop = np.cumsum(width)
            got = got + total[stop] - total[stop - width]
            last = np.where(self.end[node] > self.start[node], self.flat[np.maximum(self.end[node] - 1, 0)], -1)
            left = ends[v] - np.searchsorted(order, v * vocab + last, "right")  # the visitor's codes after the node's last one
            # common c of sets of n and m: 100 c >= similar (n + m - c)
            reach = got + np.minimum(left, self.long[node])
            alive = (100 + similar) * reach >= similar * (n[v] + self.few[node])
            v, node, got = v[alive], node[alive], got[alive]
            sets = self.hi[node] - self.lo[node]
            who, c = np.repeat(v, sets), np.repeat(got, sets)
            member = np.repeat(self.lo[node], sets) + C.ramp(sets)
            good = (100 + similar) * c >= similar * (n[who] + self.n_of[member])
            out_v.append(who[good])
            out_m.append(member[good])
            kids = self.child[node]
            if kids.any():
                stack.append((np.repeat(v, kids), np.repeat(self.first[node], kids) + C.ramp(kids), np.repeat(got, kids)))
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *out_v]), np.concatenate([none, *out_m])


def _join_trees(similar: int):
    def run(table: pa.Table) -> pa.Table:
        own = table.column("member").to_numpy().astype(bool)
        ids, n, copies = (table.column(c).to_numpy() for c in ("set", "n", "copies"))
        lists = table.column("h").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        # Codes by falling frequency: the position of (frequency, hash) among all that occur here.
        h, df = lists.flatten().field("h").to_numpy(), lists.flatten().field("df").to_numpy()
        order = np.lexsort((h, -df))
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        codes = np.empty(len(h), np.int64)
        codes[order] = np.cumsum(new) - 1
        row = np.repeat(np.arange(len(counts)), counts)
        codes = codes[np.lexsort((codes, row))]
        mine, theirs = own[row], ~own[row]
        trie = Trie(codes[mine], counts[own], n[own])
        trie.n_of = n[own][trie.order]
        v, m = trie.links(codes[theirs], counts[~own], n[~own], similar)
        left, right = ids[~own][v], ids[own][m]
        other = left != right
        left, right, m = left[other], right[other], m[other]
        names, number = np.unique(np.concatenate([left, right]), return_inverse=True)
        use = C.forest(number[: len(left)], number[len(left) :], len(names))
        sums = np.zeros(len(names), np.int64)
        np.add.at(sums, number[: len(left)], copies[own][m])
        some = np.flatnonzero(sums)
        return pa.table({
            "a": np.concatenate([names[some], left[use]]), "b": pa.array(np.concatenate([names[some], right[use]])),
            "links": np.concatenate([sums[some], np.zeros(int(use.sum()), np.int64)]),
        })

    return run


def linked(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable by links) and n_links, the number of other documents a document links with."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("of_text", F.xxhash64("text"))
    signed = C.settle(C.map_texts(docs, "doc_id long, of_text long, set long, n long, prefix array<long>", _signed(similar)))
    one = F.min(F.struct("doc_id", "of_text"))
    sets = C.settle(signed.filter("n > 0").groupBy("set", "n").agg(F.min("doc_id").alias("least"), one.alias("one"), F.count("*").alias("copies")))

    rows = signed.select(F.explode("prefix").alias("h"), "set", "n").withColumn("at", F.monotonically_increasing_id())  # `at` only spreads equal rows
    more, need = F.expr("n div 10 + 1"), F.expr(f"n - (({similar} * n + 99) div 100)")
    possible = C.settle(_shared(rows).groupBy("set", "n").count().filter(F.col("count") >= F.least("n", more)).select("set").distinct())
    asked = C.settle(sets.join(possible, "set").select("set", "n", "copies", F.col("one.doc_id").alias("id"), F.col("one.of_text").alias("of")))

    # The texts are read again, one for each set that is left; repeated rows are made one within the tasks.
    # They are shuffled for it at any size, so that what a small table costs tells what a large one will.
    again = docs.join(asked.hint("merge"), docs["doc_id"].eqNullSafe(asked["id"]) & (docs["of_text"] == asked["of"])).groupBy("set").agg(F.any_value("text").alias("text"))
    tokens = C.settle(C.map_texts(again, "set long, h array<long>", _tokens).select("set", F.explode("h").alias("h")))
    often = tokens.groupBy("h").agg(F.count("*").cast("int").alias("df")).filter("df > 1")
    lists = tokens.join(often, "h").groupBy("set").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("h"))
    whole = lists.join(asked.select("set", "n", "copies"), "set").withColumn("q", need + 1 - (F.col("n") - F.size("h"))).filter("q > 0")
    whole = C.settle(whole.withColumn("home", F.array_min(F.transform("h", lambda t: F.xxhash64(t["h"])))).withColumn("weight", F.size("h").cast("long")))

    members = C.settle(C.loads(whole.select("home", "n", "set", "weight"), ["home"], ["n", "set"], "tree", TREE))
    prefix = whole.select("set", "n", "weight", F.explode(F.slice("h", F.lit(1), F.col("q").cast("int"))).alias("t")).select("set", "n", "weight", F.col("t.h").alias("h"))
    prefix = C.settle(prefix)
    places = prefix.select("set", "h", "n").join(members.select("set", "home", "tree"), "set").groupBy("h", "home", "tree").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("held"), F.min("set").alias("one"))
    sized = (F.lit(100) * F.col("high") >= F.lit(similar) * F.col("n")) & (F.lit(similar) * F.col("low") <= F.lit(100) * F.col("n"))
    visits = prefix.join(places, "h").filter(sized & ((F.col("held") > 1) | (F.col("one") != F.col("set")))).select("set", "weight", "home", "tree").distinct()
    visits = C.settle(C.loads(visits, ["home", "tree"], ["set"], "chunk", TREE))
    chunks = visits.groupBy("home", "tree").agg(F.max("chunk").alias("most"))
    hosts = members.join(chunks, ["home", "tree"]).select("set", "home", "tree", F.explode(F.sequence(F.lit(0), "most")).alias("chunk"), F.lit(True).alias("member"))
    both = hosts.unionByName(visits.select("set", "home", "tree", "chunk", F.lit(False).alias("member"))).join(whole.select("set", "n", "copies", "h"), "set")
    found = C.settle(both.groupBy("home", "tree", "chunk").applyInArrow(_join_trees(similar), "a long, b long, links long"))

    roots = components(found.filter("a <> b").select("a", "b"))
    counted = found.groupBy(F.col("a").alias("set")).agg(F.sum("links").alias("links"))
    classed = sets.join(roots.withColumnRenamed("node", "set"), "set", "left").select("set", "n", "least", "copies", F.coalesce("root", "set").alias("root")).join(counted, "set", "left")
    classed = C.settle(classed)
    leasts = classed.groupBy("root").agg(F.min("least").alias("component"))
    classed = classed.join(leasts, "root").select("set", "n", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    done = signed.select("doc_id", "set", "n").join(classed, ["set", "n"], "left")
    alone = F.col("n") == 0
    return done.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(C.table(spark, sf_dir, "documents"))


_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = rf"""
WITH RECURSIVE words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_AZ.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(greatest(1, len(w) - {SIZE - 1})), lambda i: array_to_string(w[i + 1:i + {SIZE}], ' '))) END AS s FROM words),
tokens AS (SELECT r, hash(unnest(s)) AS t FROM sets),
common AS MATERIALIZED (SELECT a.r AS x, b.r AS y, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.r < b.r GROUP BY ALL),
pairs AS (SELECT x, y FROM common JOIN sets a ON x = a.r JOIN sets b ON y = b.r WHERE 100 * c >= {SIMILAR} * (len(a.s) + len(b.s) - c)),
links AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT r AS x, r AS y FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id, coalesce(any_value(degree.n), 0) AS n_links
FROM sets s JOIN reach ON s.r = reach.x JOIN sets t ON t.r = reach.y LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) degree ON degree.x = s.r GROUP BY s.r, s.doc_id
"""
