import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery.operators import findings as fnd
from gleanery.plans import validate as v
from gleanery.sources.schema import MANIFEST_SCHEMA, TYPED_SCHEMA
from gleanery.sources.spec import FREE, TYPED, SourceSpec, file_name_policy, spec_of

T0 = dt.datetime(2024, 1, 1)


def record(i, **kw):
    base = dict(fuente="s", id=f"id{i:02d}", indice=i, pagina=i // 2 + 1, capturadoEn=T0, documentoUuid=f"u{i}", expediente="E", administrados=["A"],
                unidadFiscalizable="U", sector="S", resolucion="1-2014-R", anioResolucion=2014)
    return tuple((base | kw).values())


def dataset(spark, rows, **kw):
    df = spark.createDataFrame(rows, TYPED_SCHEMA)
    return {r["check"]: r for r in v.dataset_findings(df, TYPED, 2, **kw).collect()}


ORDER = ["jsonl-ilegible", "dataset-vacio", "esquema", "id-duplicado", "indice-duplicado", "pagina-incoherente", "fuente-mezclada", "indices-ausentes", "cobertura",
         "campos-vacios", "anio-sin-parsear", "sin-documento", "documento-compartido", "documento-compartido-heterogeneo"]


def test_good_dataset(spark):
    got = dataset(spark, [record(i) for i in range(4)], total=4)
    assert list(got) == ORDER and {r["level"] for r in got.values()} == {"ok"}
    assert not any(r["samples"] for r in got.values())


@pytest.mark.parametrize(
    "rows,check,level,n,samples",
    [
        ([], "dataset-vacio", "error", 0, []),
        ([record(0), record(1, id="")], "esquema", "error", 1, ["id: at least 1 character"]),
        ([record(0), record(1, pagina=0, sector=None)], "esquema", "error", 1, ["pagina: integer >= 1 | sector: required"]),
        ([record(0), record(1, administrados=["A", ""])], "esquema", "error", 1, ["administrados: at least 1 character each"]),
        ([record(0), record(1, id="id00"), record(2, id="id00"), record(3)], "id-duplicado", "error", 2, ["id00", "id00"]),
        ([record(0), record(0, id="x"), record(1)], "indice-duplicado", "error", 1, ["0"]),
        ([record(0), record(1, pagina=2)], "pagina-incoherente", "error", 1, ["index 1 page 2"]),
        ([record(0), record(1, fuente="t")], "fuente-mezclada", "error", 2, ["s", "t"]),
        ([record(0), record(3)], "indices-ausentes", "aviso", 2, ["1", "2"]),
        ([record(0), record(1)], "cobertura", "no-evaluable", 2, []),
        ([record(0, sector=" "), record(1, administrados=[], expediente="")], "campos-vacios", "error", 3, ["id00:sector", "id01:expediente", "id01:administrados"]),
        ([record(0, anioResolucion=None, resolucion="odd"), record(1)], "anio-sin-parsear", "error", 1, ["odd"]),
        ([record(0, anioResolucion=None, documentoUuid=None), record(1)], "anio-sin-parsear", "ok", 0, []),
        ([record(0, documentoUuid=None), record(1)], "sin-documento", "ok", 1, []),
        ([record(0), record(1, documentoUuid="u0")], "documento-compartido", "ok", 1, []),
        ([record(0), record(1, documentoUuid="u0")], "documento-compartido-heterogeneo", "ok", 0, []),
        ([record(0), record(1, documentoUuid="u0", expediente="F")], "documento-compartido-heterogeneo", "aviso", 1, ["u0"]),
    ],
)
def test_every_dataset_check(spark, rows, check, level, n, samples):
    r = dataset(spark, rows)[check]
    assert (r["level"], r["n"], list(r["samples"])) == (level, n, samples)


@pytest.mark.parametrize("total,level", [(4, "ok"), (5, "error"), (3, "error")])
def test_coverage(spark, total, level):
    assert dataset(spark, [record(0), record(3)], total=total)["cobertura"]["level"] == level


def test_corrupt_lines_and_samples_are_capped(spark):
    got = dataset(spark, [record(i, sector="") for i in range(9)], corrupt=2)
    assert got["jsonl-ilegible"]["level"] == "error"
    assert (got["campos-vacios"]["n"], list(got["campos-vacios"]["samples"])) == (9, [f"id0{i}:sector" for i in range(5)])


def entry(i, **kw):
    base = dict(id=f"id{i:02d}", fuente="s", documentoUuid=f"u{i}", pagina=1, indice=i, archivo=f"f{i}", bytes=10, sha256="h", nombreServidor=None, descargadoEn=T0, seq=i)
    return tuple((base | kw).values())


def documents(spark, entries, files=(), queued=0, invalid=0, records=None):
    rec = spark.createDataFrame(records or [record(i) for i in range(4)], TYPED_SCHEMA)
    man = spark.createDataFrame(list(entries), MANIFEST_SCHEMA)
    probe = None if files is None else spark.createDataFrame(list(files), "archivo string, bytes bigint, sha256 string")
    queue = None if queued is None else spark.range(queued)
    return {r["check"]: r for r in v.documents_findings(rec, man, probe, queue, invalid).collect()}


DOC_ORDER = ["manifiesto-invalido", "manifiesto-vacio", "manifiesto-duplicado", "manifiesto-huerfano", "manifiesto-uuid", "archivo-compartido", "cobertura-descargas",
             "archivo-ausente", "tamano-distinto", "hash-distinto", "dlq-pendientes"]
FILES = [("f0", 10, "h"), ("f1", 10, "h")]


def test_good_documents(spark):
    got = documents(spark, [entry(0), entry(1)], FILES)
    assert list(got) == DOC_ORDER and {r["level"] for r in got.values()} == {"ok"}
    assert got["cobertura-descargas"]["message"] == "2 of 4 records with a document"


def test_empty_manifest(spark):
    got = documents(spark, [], FILES)
    quiet = {"manifiesto-duplicado", "manifiesto-huerfano", "manifiesto-uuid", "archivo-compartido", "archivo-ausente", "tamano-distinto", "hash-distinto"}
    assert {c for c, r in got.items() if r["level"] == "no-evaluable"} == quiet
    assert got["manifiesto-vacio"]["level"] == "aviso" and got["cobertura-descargas"]["message"].startswith("0 of 4")


@pytest.mark.parametrize(
    "kw,check,level,n",
    [
        (dict(entries=[entry(0)], invalid=3), "manifiesto-invalido", "error", 3),
        (dict(entries=[entry(0), entry(0)]), "manifiesto-duplicado", "error", 1),
        (dict(entries=[entry(9)]), "manifiesto-huerfano", "error", 1),
        (dict(entries=[entry(0, documentoUuid="x"), entry(0, documentoUuid="x")]), "manifiesto-uuid", "error", 2),
        (dict(entries=[entry(0)], records=[record(0, documentoUuid=None)]), "manifiesto-uuid", "error", 1),
        (dict(entries=[entry(0), entry(1, archivo="f0")]), "archivo-compartido", "ok", 1),
        (dict(entries=[entry(0, archivo="no"), entry(1, archivo="no")]), "archivo-ausente", "error", 1),
        (dict(entries=[entry(0, bytes=9), entry(1, archivo="f0", bytes=8)]), "tamano-distinto", "error", 2),
        (dict(entries=[entry(0, sha256="g")]), "hash-distinto", "error", 1),
        (dict(entries=[entry(0)], files=[("f0", 10, None)]), "hash-distinto", "no-evaluable", 0),
        (dict(entries=[entry(0)], files=None), "archivo-ausente", "no-evaluable", 0),
        (dict(entries=[entry(0)], files=[]), "archivo-ausente", "error", 1),
        (dict(entries=[entry(0)], queued=2), "dlq-pendientes", "aviso", 2),
        (dict(entries=[entry(0)], queued=None), "dlq-pendientes", "no-evaluable", 0),
    ],
)
def test_every_document_check(spark, kw, check, level, n):
    r = documents(spark, **({"files": FILES} | kw))[check]
    assert (r["level"], r["n"]) == (level, n)


def test_site_section(spark):
    rec = spark.createDataFrame([record(0), record(1)], TYPED_SCHEMA)
    shown = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    level = lambda *a: [(r["check"], r["level"], r["n"]) for r in v.site_findings(rec, *a).collect()]
    assert level(shown("id00", "id01"), 2) == [("sitio-total", "ok", 2), ("sitio-primera-pagina", "ok", 0)]
    assert level(shown("id00", "new"), 2)[1] == ("sitio-primera-pagina", "error", 1)
    assert level(None, None) == [("sitio-alcanzable", "error", 1)]
    some = v.site_findings(rec, shown("id00", "new"), 2).collect()[1]["message"]
    none = v.site_findings(rec, shown("new"), 2).collect()[1]["message"]
    assert some != none


def test_report_does_not_depend_on_partitions(spark):
    rows = [record(i, id=f"id{i % 7}", sector=" " if i % 5 == 0 else "S", documentoUuid=f"u{i % 4}") for i in range(40)]
    df = spark.createDataFrame(rows, TYPED_SCHEMA)
    seen = set()
    for n in (1, 3, 9):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        got = v.validate(df.repartition(n), TYPED, 2, total=40, site=(df.limit(2), 40))
        seen.add(str([tuple(r) for r in got.orderBy("section_order", "check_order").collect()]))
        sections = [r["section"] for r in got.collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1 and len(sections) == 14 + 11 + 2


def test_levels_and_text(spark):
    rows = [(1, "dataset", 1, "a", "error", 1, "m", ["x", "y"]), (1, "dataset", 2, "long", "ok", 0, "fine", [])]
    df = spark.createDataFrame(rows, "section_order int, section string, check_order int, check string, level string, n bigint, message string, samples array<string>")
    assert tuple(fnd.levels(df).first()) == (1, 0, 1, 0, True)
    assert [r["line"] for r in fnd.report_lines(df).orderBy("check_order").collect()] == ["  ✗ a     m · e.g. x, y", "  ✓ long  fine"]


def test_declared_total():
    assert v.declared_total(1, 2, 3) == (1, "site") and v.declared_total(None, None, 3) == (3, "checkpoint") and v.declared_total(None, None, None) == (None, None)


def test_schemaless_source_has_no_domain_checks(spark):
    rows = [("s", "a", 0, 1, T0, None, {"x": "y"}, "t"), ("s", "b", 1, 1, T0, "d", {}, "")]
    got = {r["check"]: r["level"] for r in v.dataset_findings(spark.createDataFrame(rows, FREE.schema), FREE, 10).collect()}
    assert len(got) == 9 and got["esquema"] == "error"


def test_specs(spark):
    with pytest.raises(KeyError, match="known: free, typed"):
        spec_of("other")
    df = spark.createDataFrame([("a", "u", "", "Exp 1", "x"), ("a", "u", "1-2014/R", "E", "x"), ("b", "u", None, None, "///"), ("b", "u", None, None, "Ño ño")], "s string, documentoUuid string, resolucion string, expediente string, texto string")
    assert [r[0] for r in df.select(file_name_policy(F.col("s"), {"a": TYPED, "b": FREE})).collect()] == ["u_exp-1.pdf", "u_1-2014-r.pdf", "u.pdf", "u_no-no.pdf"]
    with pytest.raises(Exception, match="no file-name rule"):
        df.select(file_name_policy(F.col("s"), {"a": TYPED})).collect()
    only = SourceSpec("only", TYPED.schema, 10, TYPED.rules, TYPED.record_id, TYPED.file_name, literal_source="mine")
    bad = spark.createDataFrame([record(0)], TYPED_SCHEMA).select(only.issues()).first()[0]
    assert bad == ["fuente: expected mine"]


def test_report_over_files(spark, tmp_path):
    """Torn lines and malformed entries are counted, the resume state gives the total, a broken queue or state does not end the report."""
    from gleanery.plans.validate import validate_files
    from gleanery.sources.spec import default_paths

    p = default_paths(str(tmp_path), "typed", "scrape")
    none, notes = validate_files(spark, TYPED, 10, p)
    got = {r["check"]: r for r in none.collect()}
    assert notes == [] and got["dataset-vacio"]["level"] == "error" and got["cobertura"]["level"] == "no-evaluable"
    line = '{{"fuente":"s","id":"{}","indice":{},"pagina":1,"capturadoEn":"2024-01-01T00:00:00Z","expediente":"e","administrados":["a"],"unidadFiscalizable":"u","sector":"x","resolucion":"r"}}\n'
    (tmp_path / "typed.jsonl").write_text("".join(line.format("i" * 20 + f"{i:04d}", i) for i in (0, 1, 3)) + '{"id":"x","indice":"zz"}\n{"fuente":"s","id"')
    (tmp_path / "typed.descargas.jsonl").write_text('{"id":"a","documentoUuid":"d","archivo":"f"}\nxx\n')
    (tmp_path / "typed.failed.jsonl").write_text("no queue\n")
    (tmp_path / "typed.scrape.checkpoint.json").write_text('{"fuente":"typed","tarea":"scrape","pageSize":10,"total":4,"ultimaPagina":1,"completo":false,"registros":3,"actualizadoEn":"2024-01-01T00:00:00Z"}')
    report, notes = validate_files(spark, TYPED, 10, p)
    got = {r["check"]: (r["level"], r["n"]) for r in report.collect()}
    assert got["jsonl-ilegible"] == ("error", 1) and got["esquema"] == ("error", 1)  # a position of another type is JSON all the same
    assert got["manifiesto-invalido"] == ("error", 2)
    assert got["cobertura"] == ("ok", 0) and got["indices-ausentes"] == ("aviso", 1)
    assert got["dlq-pendientes"][0] == "no-evaluable" and len(notes) == 1 and "queue" in notes[0]
    (tmp_path / "typed.scrape.checkpoint.json").write_text('{"fuente":"","total":-1}')
    report, notes = validate_files(spark, TYPED, 10, p)
    assert {r["check"]: r["level"] for r in report.collect()}["cobertura"] == "no-evaluable" and any("checkpoint" in n for n in notes)
    # The documents' folder is looked at; what is no fault of a file's content ends the report.
    import hashlib

    (tmp_path / "typed").mkdir()
    (tmp_path / "typed" / "f").write_bytes(b"abc")
    entry = '{{"id":"a","documentoUuid":"d","archivo":"{}","bytes":{},"sha256":"{}"}}\n'
    (tmp_path / "typed.descargas.jsonl").write_text(entry.format("f", 3, hashlib.sha256(b"abd").hexdigest()) + entry.format("gone", 1, "x"))
    by_size, _ = validate_files(spark, TYPED, 10, p)
    by_hash, _ = validate_files(spark, TYPED, 10, p, hashed=True)
    disk = [{r["check"]: (r["level"], r["n"]) for r in x.collect()} for x in (by_size, by_hash)]
    assert [d["archivo-ausente"] for d in disk] == [("error", 1)] * 2 and [d["tamano-distinto"] for d in disk] == [("ok", 0)] * 2
    assert [d["hash-distinto"] for d in disk] == [("no-evaluable", 0), ("error", 1)]
    assert not v.unreadable(OSError("disk full")) and not v.unreadable(RuntimeError("executor lost"))


def test_checks_of_a_source(spark):
    from dataclasses import replace

    from gleanery.sources.spec import Check

    own = replace(TYPED, checks=(
        Check("a", "odd positions", rule=lambda: F.col("indice") % 2 == 1, label=lambda: F.concat(F.lit("p"), "indice")),
        Check("b", "sectors repeat", key=lambda: F.col("sector"), level="aviso"),
        Check("c", "nothing", rule=lambda: F.lit(None).cast("boolean")),
    ))
    df = spark.createDataFrame([record(i, id=f"id{i:020d}", sector=f"S{min(i, 3)}") for i in range(6)] + [record(6, id="")], TYPED_SCHEMA)
    rows = v.dataset_findings(df, own, 10).collect()
    got = {r["check"]: (r["level"], r["n"], r["samples"]) for r in rows}
    assert got["a"] == ("error", 3, ["p1", "p3", "p5"]) and got["b"] == ("aviso", 2, ["S3"]) and got["c"] == ("ok", 0, [])
    assert [r["check"] for r in rows][-3:] == ["a", "b", "c"] and len(rows) == 17


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    """What the checks need of the files is landed before they begin: they find the same when the files are emptied by then."""
    import hashlib

    from gleanery.sources.spec import default_paths

    p = default_paths(str(tmp_path), "typed", "scrape")
    line = '{{"fuente":"s","id":"{}","indice":{},"pagina":1,"capturadoEn":"2024-01-01T00:00:00Z","expediente":"e","administrados":["a"],"unidadFiscalizable":"u","sector":"x","resolucion":"r"}}\n'
    entry = '{{"id":"{}","documentoUuid":"d","archivo":"f","bytes":{},"sha256":"{}"}}\n'
    content = {
        "typed.jsonl": "".join(line.format("i" * 20 + f"{i:04d}", i) for i in (0, 1, 1, 3)) + '{"id"\n{"id":"x","indice":"zz"}\n',
        "typed.descargas.jsonl": entry.format("a", 3, hashlib.sha256(b"abc").hexdigest()) + entry.format("a", 4, "x") + "xx\n",
        "typed.failed.jsonl": '{"seq":1,"id":"q","tipo":"pdf","error":"e","intentos":1,"ultimoTs":"2024-01-01T00:00:00Z"}\n',
        "typed/f": "abc",
    }
    (tmp_path / "typed").mkdir()

    def fill(empty=False):
        for name, text in content.items():
            (tmp_path / name).write_text("" if empty else text)

    def emptied_before(check):
        def run(*args):
            fill(empty=True)
            return check(*args)

        return run

    fill()
    want = {r["check"]: (r["level"], r["n"], r["samples"]) for r in v.validate_files(spark, TYPED, 10, p, hashed=True)[0].collect()}
    assert {c: want[c][1] for c in ("jsonl-ilegible", "esquema", "dataset-vacio", "indice-duplicado", "manifiesto-invalido", "manifiesto-vacio", "tamano-distinto", "hash-distinto", "dlq-pendientes")} == {
        "jsonl-ilegible": 1, "esquema": 1, "dataset-vacio": 4, "indice-duplicado": 1, "manifiesto-invalido": 1, "manifiesto-vacio": 2, "tamano-distinto": 1, "hash-distinto": 1, "dlq-pendientes": 1,
    }
    for name in ("findings_of_marks", "documents_findings"):
        monkeypatch.setattr(v, name, emptied_before(getattr(v, name)))
    report, notes = v.validate_files(spark, TYPED, 10, p, hashed=True)
    assert notes == [] and {r["check"]: (r["level"], r["n"], r["samples"]) for r in report.collect()} == want


def test_a_strict_scan_parses_a_line_once(spark, tmp_path):
    """The filter on broken lines holds no parsing of its own: one for the fields, one for what lines with a NULL field were given."""
    from gleanery.sources.manifest import queue_scan

    (tmp_path / "q").write_text('{"seq":1,"id":"q","tipo":"pdf","error":"e","intentos":1,"ultimoTs":"2024-01-01T00:00:00Z"}\n')
    assert queue_scan(spark, str(tmp_path / "q"))._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2
