import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery.plans import downloads, drift, resume, retry



def NOW():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")

T0 = dt.datetime(2024, 1, 1)


def queue(spark, *rows):
    """seq, id, error, tries, page"""
    data = [(s, i, "pdf", e, n, T0, "d", {} if p is None else {"pagina": p}) for s, i, e, n, p in rows]
    return spark.createDataFrame(data, "seq bigint, id string, tipo string, error string, intentos int, ultimoTs timestamp, detalle string, contexto map<string,string>")


def test_collapse_keeps_file_order(spark):
    q = queue(spark, (1, "a", "network", 9, "1"), (2, "b", "throttled", 1, "2"), (3, "a", "throttled", 2, "3"))
    assert sorted((r["id"], r["intentos"]) for r in retry.collapse(q).collect()) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize(
    "pages,span", [(["3", "7", "5"], (3, 3, 7)), (["3", None], (2, None, None)), (["3", "0"], (2, None, None)), (["3", "x"], (2, None, None)), ([], (0, None, None))]
)
def test_page_span(spark, pages, span):
    q = queue(spark, *[(i, f"r{i}", "network", 1, p) for i, p in enumerate(pages)])
    assert tuple(retry.page_span(q).first()) == span


@pytest.mark.parametrize("complete", [True, False])
def test_reconcile(spark, complete):
    q = queue(spark, (1, "again", "network", 1, "1"), (2, "solved", "network", 1, "1"), (3, "lost", "throttled", 2, "1"), (4, "done", "network", 5, "1"), (5, "other", "x", 1, "1"))
    q = q.withColumn("tipo", F.when(F.col("id") == "other", "page").otherwise(F.col("tipo")))
    new = queue(spark, (6, "again", "documento-magic", 2, "1"), (7, "stranger", "network", 1, "1"))
    resolved = spark.createDataFrame([("solved",), ("solved",)], "id string")
    got = {r["id"]: (r["error"], r["intentos"], r["ultimoTs"].year) for r in retry.reconcile(q, new, resolved, complete, NOW()).collect()}
    lost = ("no-encontrado", 3, 2030) if complete else ("throttled", 2, 2024)
    assert got == {"again": ("documento-magic", 2, 2024), "lost": lost, "done": ("network", 5, 2024)}


def plan_of(spark, cp, **ask):
    req = dict(fuente="s", tarea="scrape", page_size=10, desde=None, hasta=None) | ask
    requests = spark.createDataFrame([(1, *req.values())], "k int, fuente string, tarea string, page_size int, desde bigint, hasta bigint")
    state = dict(fuente="s", tarea="scrape", pageSize=10, total=100, ultimaPagina=3, completo=None) | (cp or {})
    cps = spark.createDataFrame([(1, *state.values())] if cp is not None else [], "k int, fuente string, tarea string, pageSize int, total bigint, ultimaPagina int, completo boolean")
    r = resume.resume_plan(requests, cps, ["k"]).first()
    return r["plan"], r["from_page"], r["total_expected"]


@pytest.mark.parametrize(
    "cp,ask,want",
    [
        (None, {}, ("start", None, None)),
        ({}, {}, ("resume", 4, 100)),
        ({}, {"desde": 2}, ("asked", 2, None)),
        ({"fuente": "x"}, {}, ("ignored", None, None)),
        ({"tarea": "download"}, {}, ("ignored", None, None)),
        ({"pageSize": 20}, {}, ("ignored", None, None)),
        ({"ultimaPagina": 0}, {}, ("ignored", None, None)),
        ({"completo": True}, {"hasta": 50}, ("done", None, None)),
        ({"completo": False}, {}, ("resume", 4, 100)),
        ({}, {"hasta": 3}, ("covered", None, None)),
        ({}, {"hasta": 4}, ("resume", 4, 100)),
        ({"ultimaPagina": 10}, {}, ("done", None, None)),
        ({"ultimaPagina": 10, "pageSize": 0}, {"page_size": 0}, ("resume", 11, 100)),
        ({"total": 0, "ultimaPagina": 1}, {}, ("done", None, None)),
    ],
)
def test_resume_plan(spark, cp, ask, want):
    assert plan_of(spark, cp, **ask) == want


def test_page_range():
    assert resume.page_range(9) == (1, 9) and resume.page_range(9, 2, 100) == (2, 9)
    for desde, hasta in ((0, None), (10, None), (5, 4)):
        with pytest.raises(resume.InvalidRange):
            resume.page_range(9, desde, hasta)


REC = "id string, indice bigint, documentoUuid string, pagina bigint, fuente string, name string"
MAN = "id string, documentoUuid string, archivo string, bytes bigint, sha256 string, seq bigint"


def planned(spark, records, manifest, files, **kw):
    r = spark.createDataFrame([(i, n, d, 1, "s", f) for i, n, d, f in records], REC)
    m = spark.createDataFrame([(i, d, a, 9, "h", s) for s, (i, d, a) in enumerate(manifest)], MAN)
    p = spark.createDataFrame([(a, b, "h") for a, b in files], "archivo string, bytes bigint, sha256 string")
    return {x["id"]: (x["state"], x["archivo"]) for x in downloads.download_plan(r, m, p, F.col("name"), **kw).collect()}


RECORDS = [("a", 0, "d1", "n1"), ("b", 1, "d1", "n2"), ("c", 2, None, "x"), ("d", 3, "d2", "n4"), ("e", 4, "d3", "n5"), ("f", 5, "d3", "n6"), ("g", 6, "d3", "n7"), ("h", 7, "", "x")]


def test_download_plan(spark):
    manifest = [("a", "d1", "old"), ("z", "d1", "m1"), ("d", "d2", "m2")]
    files = [("m1", 5000), ("m2", 100), ("n4", 1023), ("n6", 2000)]
    got = planned(spark, RECORDS, manifest, files)
    assert got == {
        "a": ("present", "m1"), "b": ("present", "m1"), "c": ("no-document", None), "h": ("no-document", None),
        "d": ("pending", "n4"), "e": ("pending", "n5"), "f": ("shared", "n6"), "g": ("shared", "n7"),
    }
    dry = planned(spark, RECORDS, manifest, files, dry_run=True)
    assert [dry[i][0] for i in "efg"] == ["pending", "present", "present"]
    first_there = planned(spark, RECORDS, [], [("n5", 1024)])
    assert [first_there[i][0] for i in "aefg"] == ["pending", "present", "present", "present"]


def test_manifest_entries_run_twice(spark):
    r = spark.createDataFrame([("a", 0, "d1", 1, "s", "n1"), ("a", 5, "d1", 1, "s", "n1"), ("b", 1, "d1", 1, "s", "n1"), ("c", 2, "d9", 1, "s", "n9")], REC)
    p = spark.createDataFrame([("n1", 2000, "h")], "archivo string, bytes bigint, sha256 string")
    m = spark.createDataFrame([], MAN)
    new = downloads.manifest_entries(downloads.download_plan(r, m, p, F.col("name")), p, m, NOW())
    assert sorted((x["id"], x["indice"], x["bytes"]) for x in new.collect()) == [("a", 0, 2000), ("b", 1, 2000)]
    noted = m.unionByName(new.select("id", "documentoUuid", "archivo", "bytes", "sha256", F.col("indice").alias("seq")))
    assert downloads.manifest_entries(downloads.download_plan(r, noted, p, F.col("name")), p, noted, NOW()).count() == 0


def test_run_summary(spark):
    r = spark.createDataFrame([(i, n, d, 1, "s", f) for i, n, d, f in RECORDS], REC)
    plan = downloads.download_plan(r, spark.createDataFrame([], MAN), spark.createDataFrame([("n4", 5000, "h")], "archivo string, bytes bigint, sha256 string"), F.col("name"))
    results = spark.createDataFrame([("a", "ok", 70), ("e", "magic", 0)], "id string, result string, bytes bigint")
    got = downloads.run_summary(plan, results).first().asDict()
    assert got == {"downloaded": 1, "present": 1, "shared": 3, "no_document": 2, "failed": 1, "pending": 0, "bytes": 70, "success_pct": 50.0}
    assert [x["id"] for x in downloads.next_downloads(plan, 1).collect()] == ["a"]


PAGE = dict(run_id=1, numero=1, first=0, total=20, page_size=2, widget_page_size=2, is_search=False, previous_total=None, label_total=20, has_component=True, marked_empty=False, headers=["A"], expected_headers=["A"])
PAGE_DDL = "run_id int, numero int, first bigint, total bigint, page_size bigint, widget_page_size bigint, is_search boolean, previous_total bigint, label_total bigint, has_component boolean, marked_empty boolean, headers array<string>, expected_headers array<string>"
ROW_DDL = "run_id int, numero int, pos bigint, indice bigint, nro bigint, columnas int, estado string, id string, valid boolean, sin_administrado boolean, sin_expediente boolean, sin_celdas boolean"


def good_rows(numero, ids):
    base = (numero - 1) * 2
    return [dict(run_id=1, numero=numero, pos=p, indice=base + p, nro=base + p + 1, columnas=7, estado="ok", id=i, valid=True, sin_administrado=False, sin_expediente=False, sin_celdas=False) for p, i in enumerate(ids)]


def signs(spark, page=None, row=None, ids=("c", "d"), drop=0, earlier=("a", "b")):
    rows = good_rows(2, ids)[: 2 - drop]
    if row and rows:
        rows[-1].update(row)
    pages = spark.createDataFrame([tuple(PAGE.values()), tuple((PAGE | dict(numero=2, first=2) | (page or {})).values())], PAGE_DDL)
    all_rows = spark.createDataFrame([tuple(r.values()) for r in good_rows(1, earlier) + rows], ROW_DDL)
    found = drift.page_findings(pages, all_rows).where("numero = 2")
    return sorted(r["kind"] for r in found.collect()), [r["kind"] for r in drift.first_sign(found).collect()]


@pytest.mark.parametrize(
    "kw,kinds",
    [
        ({}, []),
        ({"page": {"widget_page_size": 5}}, ["page-size"]),
        ({"page": {"widget_page_size": None}}, []),
        ({"page": {"is_search": True, "total": None}}, ["sin-total"]),
        ({"page": {"is_search": True, "previous_total": 19}}, ["total-inestable"]),
        ({"page": {"has_component": False}, "drop": 2}, ["sin-filas"]),
        ({"drop": 2}, ["sin-filas"]),
        ({"page": {"is_search": True, "total": 0, "label_total": None, "marked_empty": True}, "drop": 2}, []),
        ({"drop": 1}, ["pagina-incompleta"]),
        ({"row": {"indice": 9, "nro": 10}}, ["indices-desalineados"]),
        ({"row": {"columnas": 6}}, ["columnas"]),
        ({"row": {"nro": None}}, ["numeracion"]),
        ({"row": {"estado": "ilegible"}}, ["sin-uuid"]),
        ({"row": {"valid": False}}, ["registro-invalido"]),
        ({"ids": ("b", "a")}, ["solapamiento"]),
        ({"ids": ("b", "x")}, ["duplicados"]),
        ({"ids": ("x", "x")}, ["filas_identicas"]),
        ({"page": {"headers": ["B"]}}, ["cabeceras"]),
        ({"page": {"headers": []}}, []),
        ({"page": {"label_total": 21}}, ["totales-distintos"]),
        ({"row": {"estado": "sin-enlace"}}, ["sin_documento"]),
        ({"row": {"sin_administrado": True, "sin_expediente": True, "sin_celdas": True}}, ["sin_administrado", "sin_celdas", "sin_expediente"]),
    ],
)
def test_every_kind_of_drift(spark, kw, kinds):
    got, first = signs(spark, **kw)
    assert got == kinds
    quiet = {"duplicados", "filas_identicas", "cabeceras", "totales-distintos", "sin_documento", "sin_administrado", "sin_expediente", "sin_celdas"}
    assert first == [k for k in kinds if k not in quiet]


def test_first_sign_goes_by_row_then_rule(spark):
    rows = good_rows(1, ("a", "b"))
    rows[0]["valid"], rows[1]["columnas"] = False, 6
    pages = spark.createDataFrame([tuple(PAGE.values())], PAGE_DDL)
    found = drift.page_findings(pages, spark.createDataFrame([tuple(r.values()) for r in rows], ROW_DDL))
    assert drift.first_sign(found).first()["kind"] == "registro-invalido"


def test_numbering_per_page(spark):
    rows = good_rows(2, ("a", "b"))
    for p, r in enumerate(rows):
        r["indice"], r["nro"] = p, None
    pages = spark.createDataFrame([tuple((PAGE | dict(numero=2, first=2)).values())], PAGE_DDL)
    found = drift.page_findings(pages, spark.createDataFrame([tuple(r.values()) for r in rows], ROW_DDL), numbered_per_page=True)
    assert found.count() == 0
    lost = spark.createDataFrame([tuple((PAGE | dict(is_search=True, total=None, has_component=False)).values()), tuple((PAGE | dict(numero=2, first=2, has_component=False)).values())], PAGE_DDL)
    found = drift.page_findings(lost, spark.createDataFrame([], ROW_DDL), numbered_per_page=True)
    assert sorted((r["numero"], r["kind"]) for r in found.collect()) == [(1, "sin-iterador"), (1, "sin-total"), (2, "sin-filas")]
    assert sorted((r["numero"], r["kind"]) for r in drift.first_sign(found).collect()) == [(1, "sin-iterador"), (2, "sin-filas")]


def test_pages_that_a_limit_cuts(spark):
    from gleanery.plans import downloads

    states = ["present", "pending", "pending", "no-document", "pending", "shared", "pending", "pending"]
    plan = spark.createDataFrame([(f"r{i}", i, i // 3 + 1, s) for i, s in enumerate(states)], "id string, indice bigint, pagina bigint, state string").repartition(3)

    def pages(n):
        return [tuple(r) for r in downloads.pages_reached(downloads.reached(plan, n)).orderBy("pagina").collect()]

    assert pages(3) == [(1, 3, 2, True, True), (2, 2, 1, False, True)]
    assert pages(2) == [(1, 3, 2, True, True)]  # the limit is met where a page ends: the page is complete, the next one not begun
    assert pages(5) == [(1, 3, 2, True, False), (2, 3, 1, True, False), (3, 2, 2, True, False)]  # met by the very last row
    assert pages(0) == [] and downloads.reached(plan.limit(0), 3).count() == 0
