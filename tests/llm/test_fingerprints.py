import hashlib

from gleanery.llm import common as C
from gleanery.llm import fingerprints as H
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_edited_texts_by_brute_force(spark):
    got = {r.doc_id: r for r in H.op5_fingerprints(spark, SF).collect()}
    docs = {r.doc_id: r.text or "" for r in C.table(spark, SF, "documents").collect()}
    ids = sorted(docs)
    assert set(got) == set(ids)
    for d, follows in zip(ids, ids[1:] + ids[:1], strict=True):
        t, n = docs[d], len(docs[d])
        new = t[: n - n // 4] + docs[follows][: n // 4]
        assert got[d].n_chars == n and got[d].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    by_text = {}
    for d in ids:
        assert by_text.setdefault(docs[d], got[d].fingerprint) == got[d].fingerprint
    assert len(set(by_text.values())) == len(by_text)
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.5 > 0.1 > mean("near_next")


def lanes(spark, texts):
    df = H.with_lanes(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", "lanes")
    return [r.lanes for r in df.orderBy("i").collect()], df


def test_sums_of_paragraphs(spark):
    texts = ["a one.\nb two. more\nc", "c\na one.\nb two. more", "a one.\nb two. more", "c", None, ""]
    (first, other, two, last, null, empty), df = lanes(spark, texts)
    assert first == other != two and null == empty
    both = df.filter("i = 2").crossJoin(df.filter("i = 3").select(F.col("lanes").alias("more")))
    assert both.select(H.add(F.col("lanes"), F.col("more"))).first()[0] == first
    whole = df.filter("i = 0").crossJoin(df.filter("i = 3").select(F.col("lanes").alias("less")))
    assert whole.select(H.remove(F.col("lanes"), F.col("less"))).first()[0] == two


def test_awkward_documents(awkward, nothing, spark):
    rows = H.edited(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.edited for r in rows if r.text == ""} == {""}
    assert H.edited(nothing).count() == 0
    one = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert H.edited(one).first().edited == "abcdefab"


def test_no_python_in_the_plan(spark):
    plan = H.op5_fingerprints(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapInPandas" not in plan
