import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gleanery.llm import manifest as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """Merkle tree by loops: per row (leaf, subroot, root, proof hash, folded root)."""

    def fields(r):
        return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)

    def tree(nodes):
        paths, level, where = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
        while len(level) > 1:
            for path, w in zip(paths, where, strict=True):
                run = level[w // 2 * 2 : w // 2 * 2 + 2]
                path.append((w % 2, [x for i, x in enumerate(run) if i != w % 2]))
            level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
            where = [w // 2 for w in where]
        return level[0], paths

    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, H(fields(r)), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([leaf for *_, leaf, _ in sorted(by[x], key=lambda t: t[:3])]) for x in langs}
    root, tops = tree([trees[x][0] for x in langs]) if langs else (None, [])
    out = []
    for x, top in zip(langs, tops, strict=True):
        for (_, _, leaf, r), path in zip(sorted(by[x], key=lambda t: t[:3]), trees[x][1], strict=True):
            d = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                d = H(fields([*r[:3], r[3] + 1, r[4]]))
            for odd, sib in path + top:
                d = H(*(sib + [d] if odd else [d] + sib))
            out.append((r[0], leaf, trees[x][0], root, H(*[s for _, sib in path + top for s in sib]), d))
    return sorted(out, key=str)


def run(spark, monkeypatch, docs):
    monkeypatch.setattr(M.C, "table", lambda *_: docs)
    return sorted((tuple(r)[:6] for r in M.op13_merkle_manifest(spark, "").collect()), key=str)


def test_awkward_rows(spark, monkeypatch, awkward, nothing):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in awkward.collect()]
    assert run(spark, monkeypatch, awkward) == brute(rows)
    assert run(spark, monkeypatch, nothing) == []


@pytest.mark.parametrize("n", [1, 257, 600])
def test_sizes_around_a_stride(spark, monkeypatch, n):
    rows = [(i, "s", ("x", "é", None)[min(i // 300, 2)], i, f"t{i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert run(spark, monkeypatch, docs) == brute(rows)


def test_general_interface_keeps_columns_and_verifies(spark):
    rows = spark.createDataFrame([(i % 2, i, f"v{i}") for i in range(40)], "g int, k int, seg string").withColumn("leaf", M.leaf([F.col("k"), F.col("seg")]))
    done = M.manifest(rows, "g", "k").withColumn("ok", M.fold(F.col("leaf"), F.col("proof")) == F.col("root"))
    assert done.columns[:4] == ["g", "k", "seg", "leaf"] and done.filter("ok").count() == 40
    assert done.select("root").distinct().count() == 1 and done.filter(M.fold(F.sha2(F.col("k").cast("string"), 256), F.col("proof")) == F.col("root")).isEmpty()
