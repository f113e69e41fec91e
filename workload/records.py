"""Checks, joins and plans over records, manifest and disk."""

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.operators import findings as fnd
from gleanery.operators.keep import first_occurrence, repeats
from gleanery.operators.positions import missing_intervals, missing_positions
from gleanery.operators.together import together
from gleanery.plans import downloads, drift, retry, validate
from gleanery.sources.files import probe_hash
from gleanery.sources.paths import scratch_dir
from gleanery.sources.sinks import new_records, settle
from gleanery.sources.spec import TYPED, Check, default_paths
from workload import sql as S
from workload import tables as T
from workload.registry import query

_AGG = "count(*) AS n"


@query(
    "dataset_profile",
    f"""WITH {S.RECORDS} SELECT count(*) AS lines, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid, count(DISTINCT id) FILTER (ok) AS distinct_ids,
      max(indice) FILTER (ok) AS max_index, count(*) FILTER (ok AND pagina <> indice // 10 + 1) AS misplaced FROM (SELECT *, coalesce(quality, 1) = 1 AND n_chars % 11 > 0 AS ok FROM records)""",
)
def _(spark, sf):
    """Records of low quality lost their id, some others their case."""
    broken = {"id": F.expr("if(quality = 0, '', id)"), "expediente": F.expr("if(n_chars % 11 > 0, expediente, null)")}
    return validate.dataset_profile(T.rich_records(spark, sf).withColumns(broken), TYPED, 10)


@query("duplicate_ids", f"WITH {S.RECORDS} SELECT id, {_AGG} FROM records GROUP BY id HAVING count(*) > 1")
def _(spark, sf):
    return repeats(T.records(spark, sf).select("id"), "id")


@query("repeated_lines", f"WITH {S.RECORDS} SELECT id, indice FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY indice) BETWEEN 2 AND 6")
def _(spark, sf):
    return validate.repeated_lines(T.records(spark, sf), "id", ["indice"])


@query("duplicate_positions", "SELECT l_orderkey AS indice, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return repeats(T.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("indice")), "indice")


@query("mixed_sources", f"WITH {S.RECORDS} SELECT count(DISTINCT fuente) AS sources, count(DISTINCT fuente) > 1 AS mixed FROM records")
def _(spark, sf):
    n = F.count_distinct("fuente")
    return T.records(spark, sf).agg(n.alias("sources"), (n > 1).alias("mixed"))


@query(
    "coverage",
    f"""WITH {S.RECORDS}, k AS (SELECT id, max(indice) AS indice FROM records GROUP BY id), b AS (SELECT lang, max(r.indice) + 1 AS bound, count(DISTINCT r.indice) AS present FROM k JOIN records r ON k.indice = r.indice GROUP BY lang)
      SELECT lang, bound, present, bound - present AS missing, CASE WHEN lang = 'de' THEN 'no-evaluable' WHEN bound = (SELECT count(*) FROM documents) THEN 'ok' ELSE 'error' END AS level FROM b""",
)
def _(spark, sf):
    r = T.rich_records(spark, sf)
    kept = first_occurrence(r, "id", [F.desc("indice")])
    total = T.table(spark, sf, "documents").count()
    known = F.when(F.col("lang") != "de", F.lit(total))
    bound = F.max("indice") + 1
    per = kept.groupBy("lang").agg(bound.alias("bound"), F.count_distinct("indice").alias("present"))
    level = F.when(known.isNull(), "no-evaluable").when(F.col("bound") == known, "ok").otherwise("error")
    return per.select("lang", "bound", "present", (F.col("bound") - F.col("present")).alias("missing"), level.alias("level"))


@query(
    "declared_total",
    "SELECT c_custkey, coalesce(live, given, cp) AS total, CASE WHEN live IS NOT NULL THEN 'site' WHEN given IS NOT NULL THEN 'parameter' WHEN cp IS NOT NULL THEN 'checkpoint' END AS origin FROM (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN c_custkey END AS live, CASE WHEN c_nationkey < 10 THEN c_custkey + 1 END AS given, CASE WHEN c_acctbal > 0 THEN c_custkey + 2 END AS cp FROM customer)",
)
def _(spark, sf):
    c = T.table(spark, sf, "customer").select(
        "c_custkey",
        F.expr("if(c_nationkey < 5, c_custkey, null)").alias("site"),
        F.expr("if(c_nationkey < 10, c_custkey + 1, null)").alias("parameter"),
        F.expr("if(c_acctbal > 0, c_custkey + 2, null)").alias("checkpoint"),
    )
    return c.select("c_custkey", *validate.declared_total_columns(F.col("site"), F.col("parameter"), F.col("checkpoint")))


@query(
    "blank_fields",
    f"""WITH {S.RECORDS} SELECT 'expediente' AS field, count(*) FILTER (trim(expediente) = '') AS n FROM records UNION ALL SELECT 'unidadFiscalizable', count(*) FILTER (trim(unidadFiscalizable) = '') FROM records
      UNION ALL SELECT 'sector', count(*) FILTER (trim(sector) = '') FROM records UNION ALL SELECT 'resolucion', count(*) FILTER (trim(resolucion) = '') FROM records UNION ALL SELECT 'administrados', count(*) FILTER (len(administrados) = 0) FROM records""",
)
def _(spark, sf):
    return validate.blank_fields(T.records(spark, sf), TYPED)


@query(
    "year_missing",
    f"WITH {S.RECORDS} SELECT count(*) FILTER (documentoUuid IS NOT NULL AND anioResolucion IS NULL) AS with_document, count(*) FILTER (documentoUuid IS NULL AND anioResolucion IS NULL) AS without_document FROM records",
)
def _(spark, sf):
    return validate.year_missing(T.records(spark, sf))


@query("no_document", f"WITH {S.RECORDS} SELECT count(*) FILTER (documentoUuid IS NULL) AS n, count(DISTINCT id) AS of FROM records")
def _(spark, sf):
    return validate.no_document(T.records(spark, sf))


_SHARED = "SELECT documentoUuid, count(*) AS n, min(indice) AS first_index, count(DISTINCT expediente) > 1 OR count(DISTINCT resolucion) > 1 AS heterogeneous FROM records WHERE documentoUuid IS NOT NULL GROUP BY 1 HAVING count(*) > 1"


@query("shared_documents", f"WITH {S.RECORDS} {_SHARED}")
def _(spark, sf):
    return validate.shared_documents(T.records(spark, sf))


@query(
    "shared_heterogeneous",
    f"WITH {S.RECORDS} SELECT fuente AS documentoUuid, count(*) AS n FROM records GROUP BY 1 HAVING count(*) > 1 AND (count(DISTINCT expediente) > 1 OR count(DISTINCT resolucion) > 1)",
)
def _(spark, sf):
    # Here a source stands for a document, so that groups do differ.
    by_source = T.records(spark, sf).withColumn("documentoUuid", F.col("fuente"))
    return validate.shared_documents(by_source).where("heterogeneous").select("documentoUuid", "n")


@query("shared_files", f"WITH {S.MANIFEST} SELECT archivo, {_AGG} FROM manifest GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return validate.shared_files(T.manifest(spark, sf))


@query("first_occurrence", f"WITH {S.RECORDS} SELECT indice, id, fuente FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY indice) = 1")
def _(spark, sf):
    return first_occurrence(T.records(spark, sf), "id", [F.col("indice")]).select("indice", "id", "fuente")


_STORED = "stored AS (SELECT DISTINCT id FROM records WHERE quality = 1)"


@query("new_records", f"WITH {S.RECORDS}, {_STORED} SELECT indice, id FROM records WHERE id NOT IN (SELECT id FROM stored) QUALIFY row_number() OVER (PARTITION BY id ORDER BY indice) = 1")
def _(spark, sf):
    r = T.rich_records(spark, sf)
    return new_records(r, r.where("quality = 1")).select("indice", "id")


@query("ids_except", f"WITH {S.RECORDS}, {_STORED} SELECT DISTINCT id FROM records EXCEPT SELECT id FROM stored")
def _(spark, sf):
    r = T.rich_records(spark, sf)
    return r.select("id").subtract(r.where("quality = 1").select("id"))


@query(
    "missing_positions",
    f"WITH {S.RECORDS}, kept AS (SELECT max(indice) AS indice FROM records GROUP BY id) SELECT range AS indice FROM range(0, (SELECT max(indice) + 1 FROM kept)) WHERE range NOT IN (SELECT indice FROM kept)",
)
def _(spark, sf):
    kept = T.records(spark, sf).groupBy("id").agg(F.max("indice").alias("indice"))
    return missing_positions(kept, "indice")


@query(
    "missing_intervals",
    f"WITH {S.RECORDS}, kept AS (SELECT max(indice) AS indice FROM records GROUP BY id), far AS (SELECT indice FROM kept UNION ALL SELECT 3000000000000000) SELECT before + 1 AS first, indice - 1 AS last FROM (SELECT indice, lag(indice, 1, -1) OVER (ORDER BY indice) AS before FROM far) WHERE before + 1 < indice",
)
def _(spark, sf):
    """Gaps as intervals; one record stands far beyond all others."""
    kept = T.records(spark, sf).groupBy("id").agg(F.max("indice").alias("indice"))
    return missing_intervals(kept.unionByName(spark.range(1).select(F.lit("stray").alias("id"), F.lit(3 * 10**15).alias("indice"))), "indice")


@query("manifest_orphans", f"WITH {S.MANIFEST} SELECT id, count(*) AS n, min(indice) AS first_index FROM manifest WHERE id NOT IN (SELECT id FROM records) GROUP BY id")
def _(spark, sf):
    return validate.manifest_orphans(T.manifest(spark, sf), T.records(spark, sf))


_LAST = "last AS (SELECT id, documentoUuid AS record_uuid FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY indice DESC) = 1)"
_MISMATCH = "SELECT m.id, m.documentoUuid, l.record_uuid, count(*) AS n, min(m.indice) AS first_index FROM manifest m JOIN last l ON m.id = l.id WHERE m.documentoUuid IS DISTINCT FROM l.record_uuid GROUP BY 1, 2, 3"


@query("manifest_uuid_mismatch", f"WITH {S.MANIFEST}, {_LAST} {_MISMATCH}")
def _(spark, sf):
    return validate.manifest_uuid_mismatch(T.manifest(spark, sf), T.records(spark, sf))


_DISK = """disk AS (SELECT m.archivo, m.bytes, m.sha256, count(*) AS n, p.bytes AS disk_bytes, p.sha256 AS disk_sha256, p.archivo IS NULL AS absent,
  coalesce(m.bytes <> p.bytes, false) AS size_differs, coalesce(m.sha256 <> p.sha256, false) AS hash_differs, p.sha256 IS NOT NULL AS hashed
  FROM manifest m LEFT JOIN probe p ON m.archivo = p.archivo GROUP BY ALL)"""


@query("manifest_vs_disk", f"WITH {S.MANIFEST}, {_DISK} SELECT * FROM disk")
def _(spark, sf):
    return validate.manifest_vs_disk(T.manifest(spark, sf), T.probe(spark, sf))


@query("download_coverage", f"WITH {S.MANIFEST} SELECT (SELECT count(DISTINCT id) FROM manifest) AS noted, (SELECT count(*) FROM records WHERE documentoUuid <> '') AS with_document")
def _(spark, sf):
    return validate.download_coverage(T.manifest(spark, sf), T.records(spark, sf))


def _base(spark, sf):
    return settle(T.harvest(spark, sf), "harvest")


def _noted(spark, sf, base=None):
    """The manifest, of which one source names files that nobody has."""
    return T.manifest(spark, sf, base).withColumn("archivo", F.expr("if(fuente = 'src5', concat('lost-', archivo), archivo)"))


def _plan(spark, sf, dry_run=False, base=None):
    base = _base(spark, sf) if base is None else base
    noted = _noted(spark, sf, base)
    records = base.select(*T.NARROW)
    return downloads.download_plan(records, noted, T.probe(spark, sf, base), TYPED.file_name(), dry_run=dry_run)


def _plan_sql(dry_run):
    own = "first_there <= indice" if dry_run else "first_there = first"
    later = "false" if dry_run else "indice > first"
    return f"""{S.MANIFEST}, big AS (SELECT * FROM probe WHERE bytes >= 1024), named AS (SELECT r.*, b.archivo IS NOT NULL AS there FROM records r LEFT JOIN big b ON r.archivo = b.archivo WHERE r.documentoUuid <> ''),
      docinfo AS (SELECT documentoUuid AS doc, min(indice) AS first, min(CASE WHEN there THEN indice END) AS first_there FROM named GROUP BY 1),
      noted AS (SELECT documentoUuid AS doc, archivo AS noted FROM (SELECT * REPLACE (CASE WHEN fuente = 'src5' THEN 'lost-' || archivo ELSE archivo END AS archivo) FROM manifest QUALIFY row_number() OVER (PARTITION BY documentoUuid ORDER BY seq DESC) = 1) WHERE archivo IN (SELECT archivo FROM big)),
      planned AS (SELECT n.id, n.indice, n.fuente, n.pagina, n.documentoUuid, CASE WHEN noted IS NOT NULL OR coalesce({own}, false) THEN 'present' WHEN {later} THEN 'shared' ELSE 'pending' END AS state, coalesce(noted, n.archivo) AS archivo
        FROM named n JOIN docinfo d ON n.documentoUuid = d.doc LEFT JOIN noted o ON n.documentoUuid = o.doc
        UNION ALL SELECT id, indice, fuente, pagina, documentoUuid, 'no-document', NULL FROM records WHERE documentoUuid IS NULL)"""


@query("download_plan", f"WITH {_plan_sql(False)} SELECT indice, id, state, archivo FROM planned")
def _(spark, sf):
    return _plan(spark, sf).select("indice", "id", "state", "archivo")


@query("download_plan_dry_run", f"WITH {_plan_sql(True)} SELECT indice, id, state, archivo FROM planned")
def _(spark, sf):
    return _plan(spark, sf, True).select("indice", "id", "state", "archivo")


@query("max_downloads", f"WITH {_plan_sql(False)} SELECT indice, id FROM planned WHERE state = 'pending' ORDER BY indice LIMIT 25")
def _(spark, sf):
    return downloads.next_downloads(_plan(spark, sf), 25).select("indice", "id")


@query(
    "max_downloads_pages",
    f"""WITH {_plan_sql(False)}, run AS (SELECT *, coalesce(sum(CASE WHEN state = 'pending' THEN 1 ELSE 0 END) OVER (ORDER BY indice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 25 AS reached FROM planned)
      SELECT r.pagina, count(*) FILTER (r.reached) AS "rows", count(*) FILTER (r.reached AND r.state = 'pending') AS downloads, bool_and(r.reached) AS complete, (SELECT count(*) FROM run WHERE NOT reached) > 0 AS limit_met
      FROM run r GROUP BY r.pagina HAVING count(*) FILTER (r.reached) > 0""",
)
def _(spark, sf):
    """The pages that a run of 25 downloads gets to: the one it stops in is not complete."""
    return downloads.pages_reached(downloads.reached(_plan(spark, sf), 25))


@query("shared_download", f"WITH {S.RECORDS} SELECT indice, documentoUuid FROM records WHERE documentoUuid <> '' QUALIFY row_number() OVER (PARTITION BY documentoUuid ORDER BY indice) > 1")
def _(spark, sf):
    return downloads.shared_downloads(T.records(spark, sf)).select("indice", "documentoUuid")


@query(
    "manifest_append",
    f"""WITH {_plan_sql(False)} SELECT p.id, p.indice, p.archivo, b.bytes, b.sha256 FROM
      (SELECT * FROM planned WHERE state = 'present' QUALIFY row_number() OVER (PARTITION BY id ORDER BY indice) = 1) p JOIN probe b ON p.archivo = b.archivo WHERE p.id NOT IN (SELECT id FROM manifest)""",
)
def _(spark, sf):
    base = _base(spark, sf)
    noted = _noted(spark, sf, base)
    new = downloads.manifest_entries(_plan(spark, sf, base=base), T.probe(spark, sf, base), noted, F.expr("timestamp_ntz'2030-01-01 00:00:00'"))
    return new.select("id", "indice", "archivo", "bytes", "sha256")


_RESULTS = """results AS (SELECT id, CASE WHEN min(n_chars) < 300 THEN 'ok' WHEN min(n_chars) < 600 THEN 'magic' END AS result, min(n_chars) AS bytes FROM records GROUP BY id)"""


@query(
    "run_summary",
    f"""WITH {_plan_sql(False)}, {_RESULTS}, w AS (SELECT p.state, r.bytes, CASE WHEN p.state = 'pending' AND result = 'ok' THEN 'downloaded' WHEN p.state = 'pending' AND result IS NOT NULL THEN 'failed' ELSE p.state END AS s FROM planned p LEFT JOIN results r ON p.id = r.id)
      SELECT count(*) FILTER (s = 'downloaded') AS downloaded, count(*) FILTER (s = 'present') AS present, count(*) FILTER (s = 'shared') AS shared, count(*) FILTER (s = 'no-document') AS no_document,
      count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'pending') AS pending, CAST(coalesce(sum(bytes) FILTER (s = 'downloaded'), 0) AS BIGINT) AS bytes,
      round(100.0 * count(*) FILTER (s = 'downloaded') / nullif(count(*) FILTER (s IN ('downloaded', 'failed')), 0), 1) AS success_pct FROM w""",
)
def _(spark, sf):
    r = T.rich_records(spark, sf).groupBy("id").agg(F.min("n_chars").alias("bytes"))
    results = r.withColumn("result", F.expr("case when bytes < 300 then 'ok' when bytes < 600 then 'magic' end"))
    return downloads.run_summary(_plan(spark, sf), results)


@query("run_status", f"WITH {_plan_sql(False)} SELECT fuente, CASE WHEN count(*) FILTER (state = 'pending') > 0 THEN 3 ELSE 0 END AS status FROM planned GROUP BY fuente")
def _(spark, sf):
    some = F.count_if(F.col("state") == "pending") > 0
    return _plan(spark, sf).groupBy("fuente").agg(downloads.run_status(F.lit(False), F.lit(False), some).alias("status"))


@query(
    "first_page_present",
    f"WITH {S.RECORDS} SELECT DISTINCT id FROM records WHERE pagina = 1 AND id NOT IN (SELECT id FROM records WHERE quality = 1)",
)
def _(spark, sf):
    r = T.rich_records(spark, sf)
    return validate.first_page_present(r.where("quality = 1"), r.where("pagina = 1"))


_T = S.thousands
_EMPTY = "CAST([] AS VARCHAR[])"


def _first5(rows: str, label: str, order: str) -> str:
    return f"coalesce((SELECT list(l ORDER BY o) FROM (SELECT CAST({label} AS VARCHAR) AS l, row_number() OVER (ORDER BY {order}) AS o FROM {rows}) WHERE o <= 5), {_EMPTY})"


def _check(section, order, check, level, n, words, samples=_EMPTY, message=None):
    message = message or f"{_T(n)} || ' {words}'"
    return f"SELECT '{section}' AS section, {order} AS check_order, '{check}' AS \"check\", {level} AS level, CAST({n} AS BIGINT) AS n, {message} AS message, {samples} AS samples FROM f"


def _err(n, level="error"):
    return f"CASE WHEN {n} > 0 THEN '{level}' ELSE 'ok' END"


_FACTS = f"""{S.MANIFEST}, {_LAST}, {_DISK}, mism AS ({_MISMATCH}), orphans AS (SELECT id, count(*) AS n, min(indice) AS first_index FROM manifest WHERE id NOT IN (SELECT id FROM records) GROUP BY id),
  shared AS ({_SHARED}), rep AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY indice) AS rn FROM records), mrep AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY indice) AS rn FROM manifest),
  files AS (SELECT archivo, bool_or(absent) AS absent, sum(CASE WHEN size_differs THEN n ELSE 0 END) AS size_n, sum(CASE WHEN hash_differs THEN n ELSE 0 END) AS hash_n FROM disk GROUP BY 1),
  q AS (SELECT count(DISTINCT 'u' || user_id) AS queued FROM events WHERE event_type = 'error'),
  hollow AS (SELECT indice, 0 AS nth, id || ':sector' AS label FROM records WHERE trim(sector) = ''),
  f AS (SELECT (SELECT count(*) FROM records) AS valid, (SELECT count(DISTINCT id) FROM records) AS ids, (SELECT max(indice) + 1 FROM records) AS bound, (SELECT count(*) FROM records WHERE pagina <> indice // 10 + 1) AS misplaced,
    (SELECT count(DISTINCT fuente) FROM records) AS sources, (SELECT count(*) FROM hollow) AS blanks, (SELECT count(*) FROM records WHERE documentoUuid IS NOT NULL AND anioResolucion IS NULL) AS no_year,
    (SELECT count(*) FROM records WHERE documentoUuid IS NULL) AS no_doc, (SELECT count(*) FROM records WHERE documentoUuid IS NOT NULL) AS with_doc, (SELECT count(*) FROM shared) AS shared_n, (SELECT count(*) FROM shared WHERE heterogeneous) AS mixed,
    (SELECT count(*) FROM manifest) AS entries, (SELECT count(DISTINCT id) FROM manifest) AS mids, (SELECT coalesce(sum(n), 0) FROM orphans) AS orphan_n, (SELECT coalesce(sum(n), 0) FROM mism) AS mism_n, (SELECT count(*) FROM (SELECT archivo FROM manifest GROUP BY 1 HAVING count(*) > 1)) AS shared_f,
    (SELECT count(*) FROM files WHERE absent) AS absent, (SELECT sum(size_n) FROM files) AS size_n, (SELECT sum(hash_n) FROM files) AS hash_n, (SELECT queued FROM q) AS queued)"""

_REPORT = " UNION ALL ".join([
    _check("dataset", 1, "jsonl-ilegible", "'ok'", "0", "unreadable lines"),
    _check("dataset", 2, "dataset-vacio", "'ok'", "valid", "valid records"),
    _check("dataset", 3, "esquema", "'ok'", "0", "records break a rule"),
    _check("dataset", 4, "id-duplicado", _err("valid - ids"), "valid - ids", "lines repeat an identity", _first5("(SELECT * FROM rep WHERE rn >= 2)", "id", "indice")),
    _check("dataset", 5, "indice-duplicado", "'ok'", "0", "lines repeat a position"),
    _check("dataset", 6, "pagina-incoherente", _err("misplaced"), "misplaced", "records on another page than their position''s", _first5("(SELECT * FROM records WHERE pagina <> indice // 10 + 1)", "'index ' || indice || ' page ' || pagina", "indice")),
    _check("dataset", 7, "fuente-mezclada", "CASE WHEN sources > 1 THEN 'error' ELSE 'ok' END", "sources", "sources", _first5("(SELECT fuente, min(indice) AS first_at FROM records GROUP BY 1)", "fuente", "first_at, fuente")),
    _check("dataset", 8, "indices-ausentes", "'ok'", "0", "positions without a record"),
    _check("dataset", 9, "cobertura", "'no-evaluable'", "bound", "rows at least; no declared total"),
    _check("dataset", 10, "campos-vacios", _err("blanks"), "blanks", "", _first5("hollow", "label", "indice, nth"), f"{_T('blanks')} || ' blank required fields' || CASE WHEN blanks > 0 THEN ': sector' ELSE '' END"),
    _check("dataset", 11, "anio-sin-parsear", _err("no_year"), "no_year", "records with a document and no ruling year", _first5("(SELECT * FROM records WHERE documentoUuid IS NOT NULL AND anioResolucion IS NULL)", "resolucion", "indice")),
    _check("dataset", 12, "sin-documento", "'ok'", "no_doc", "records without a document"),
    _check("dataset", 13, "documento-compartido", "'ok'", "shared_n", "documents reach several records"),
    _check("dataset", 14, "documento-compartido-heterogeneo", _err("mixed", "aviso"), "mixed", "shared documents differ in case or ruling", _first5("(SELECT * FROM shared WHERE heterogeneous)", "documentoUuid", "first_index, documentoUuid")),
    _check("documents", 1, "manifiesto-invalido", "'ok'", "0", "malformed entries"),
    _check("documents", 2, "manifiesto-vacio", "'ok'", "entries", "entries"),
    _check("documents", 3, "manifiesto-duplicado", _err("entries - mids"), "entries - mids", "entries repeat an identity", _first5("(SELECT * FROM mrep WHERE rn >= 2)", "id", "indice, id")),
    _check("documents", 4, "manifiesto-huerfano", _err("orphan_n"), "orphan_n", "entries without a record", _first5("orphans", "id", "first_index, id")),
    _check("documents", 5, "manifiesto-uuid", _err("mism_n"), "mism_n", "entries name another document than the record", _first5("mism", "id || ': ' || documentoUuid || ' / ' || coalesce(record_uuid, '(none)')", "first_index, id, documentoUuid")),
    _check("documents", 6, "archivo-compartido", "'ok'", "shared_f", "files serve several entries"),
    _check("documents", 7, "cobertura-descargas", "'ok'", "mids", "", message=f"{_T('mids')} || ' of ' || {_T('with_doc')} || ' records with a document'"),
    _check("documents", 8, "archivo-ausente", _err("absent"), "absent", "files are not on disk", _first5("(SELECT * FROM files WHERE absent)", "archivo", "archivo")),
    _check("documents", 9, "tamano-distinto", _err("size_n"), "size_n", "entries with another size than the file", _first5("(SELECT * FROM files WHERE size_n > 0)", "archivo", "archivo")),
    _check("documents", 10, "hash-distinto", _err("hash_n"), "hash_n", "entries with another hash than the file", _first5("(SELECT * FROM files WHERE hash_n > 0)", "archivo", "archivo")),
    _check("documents", 11, "dlq-pendientes", _err("queued", "aviso"), "queued", "documents wait in the failure queue"),
])

def _report(spark, sf):
    base = settle(T.harvest(spark, sf), "harvest")
    manifest, probe = T.manifest(spark, sf, base), T.probe(spark, sf, base)
    return validate.validate(T.records(spark, sf), TYPED, 10, manifest, probe, retry.collapse(T.queue(spark, sf)))


@query("validate_report", f"WITH {_FACTS}, report AS ({_REPORT}) SELECT section, check_order, \"check\", level, n, message, array_to_string(samples, ', ') AS samples FROM report")
def _(spark, sf):
    return _report(spark, sf).drop("section_order").withColumn("samples", F.array_join("samples", ", "))


_VALID = f"""{S.MANIFEST}, lines AS (SELECT *, coalesce(toxic, 0) = 1 AS torn, coalesce(quality, 1) = 0 AS nameless FROM (SELECT * FROM records UNION ALL SELECT * FROM records WHERE n_chars % 13 = 0)),
  valid AS (SELECT * FROM lines WHERE NOT torn AND NOT nameless), docs2 AS (SELECT documentoUuid, count(*) AS n, count(DISTINCT expediente) > 1 OR count(DISTINCT resolucion) > 1 AS mixed FROM valid WHERE documentoUuid IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
  lastv AS (SELECT id, documentoUuid AS record_uuid FROM valid QUALIFY row_number() OVER (PARTITION BY id ORDER BY indice DESC) = 1),
  e AS (SELECT *, indice % 7 = 0 AS gone, CASE WHEN indice % 7 = 0 THEN 'gone-' || (indice % 50) ELSE 'item-' || (indice % (SELECT count(*) FROM benchmark)) END AS file FROM manifest WHERE indice % 5 <> 1),
  f AS (SELECT (SELECT count(*) FROM lines WHERE torn) AS torn, (SELECT count(*) FROM lines WHERE NOT torn AND nameless) AS nameless, count(*) AS valid, count(*) - count(DISTINCT id) AS ids, count(*) - count(DISTINCT indice) AS places,
    count(*) FILTER (pagina <> indice // 10 + 1) AS misplaced, count(DISTINCT fuente) AS sources, max(indice) + 1 - count(DISTINCT indice) AS missing, (SELECT count(*) FROM documents) + 5 AS declared, max(indice) + 1 AS bound,
    count(*) FILTER (trim(sector) = '') AS blanks, count(*) FILTER (documentoUuid IS NOT NULL AND anioResolucion IS NULL) AS no_year, count(*) FILTER (documentoUuid IS NULL) AS no_doc, (SELECT count(*) FROM docs2) AS shared_n, (SELECT count(*) FROM docs2 WHERE mixed) AS mixed,
    (SELECT count(*) FROM manifest WHERE indice % 5 = 1) AS malformed, (SELECT count(*) FROM e) AS entries, (SELECT count(DISTINCT id) FROM e) AS mids, (SELECT count(*) FROM e WHERE id NOT IN (SELECT id FROM valid)) AS orphans,
    (SELECT count(*) FROM e JOIN lastv USING (id) WHERE e.documentoUuid IS DISTINCT FROM lastv.record_uuid) AS other, (SELECT count(*) FROM (SELECT file FROM e GROUP BY 1 HAVING count(*) > 1)) AS shared_f, (SELECT count(DISTINCT file) FROM e WHERE gone) AS absent,
    (SELECT count(*) FROM e WHERE NOT gone AND indice % 11 = 0) AS sizes, (SELECT count(*) FROM e WHERE NOT gone AND indice % 13 = 0) AS hashes, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'error') AS queued FROM valid)"""
_FILE_CHECKS = " UNION ALL ".join(
    f"SELECT '{section}' AS section, {order} AS check_order, '{check}' AS \"check\", {level} AS level, CAST({n} AS BIGINT) AS n FROM f"
    for section, order, check, level, n in [
        ("dataset", 1, "jsonl-ilegible", _err("torn"), "torn"), ("dataset", 2, "dataset-vacio", "CASE WHEN valid > 0 THEN 'ok' ELSE 'error' END", "valid"), ("dataset", 3, "esquema", _err("nameless"), "nameless"),
        ("dataset", 4, "id-duplicado", _err("ids"), "ids"), ("dataset", 5, "indice-duplicado", _err("places"), "places"), ("dataset", 6, "pagina-incoherente", _err("misplaced"), "misplaced"),
        ("dataset", 7, "fuente-mezclada", "CASE WHEN sources > 1 THEN 'error' ELSE 'ok' END", "sources"), ("dataset", 8, "indices-ausentes", _err("missing", "aviso"), "missing"),
        ("dataset", 9, "cobertura", "CASE WHEN bound = declared THEN 'ok' ELSE 'error' END", "declared - bound"), ("dataset", 10, "campos-vacios", _err("blanks"), "blanks"), ("dataset", 11, "anio-sin-parsear", _err("no_year"), "no_year"),
        ("dataset", 12, "sin-documento", "'ok'", "no_doc"), ("dataset", 13, "documento-compartido", "'ok'", "shared_n"), ("dataset", 14, "documento-compartido-heterogeneo", _err("mixed", "aviso"), "mixed"),
        ("documents", 1, "manifiesto-invalido", _err("malformed"), "malformed"), ("documents", 2, "manifiesto-vacio", "CASE WHEN entries > 0 THEN 'ok' ELSE 'aviso' END", "entries"),
        ("documents", 3, "manifiesto-duplicado", _err("entries - mids"), "entries - mids"), ("documents", 4, "manifiesto-huerfano", _err("orphans"), "orphans"), ("documents", 5, "manifiesto-uuid", _err("other"), "other"),
        ("documents", 6, "archivo-compartido", "'ok'", "shared_f"), ("documents", 7, "cobertura-descargas", "'ok'", "mids"), ("documents", 8, "archivo-ausente", _err("absent"), "absent"),
        ("documents", 9, "tamano-distinto", _err("sizes"), "sizes"), ("documents", 10, "hash-distinto", _err("hashes"), "hashes"), ("documents", 11, "dlq-pendientes", _err("queued", "aviso"), "queued"),
    ]
)


@query("validate_files", f"WITH {_VALID} {_FILE_CHECKS}")
def _(spark, sf):
    """Files with torn lines, nameless records, lines that occur twice, entries without a hash, a total in the resume state, a queue, and a
    folder of files, of which some are gone and some have another size or content than was noted. All 25 checks."""
    r = T.rich_records(spark, sf)
    twice = F.explode(F.expr("if(n_chars % 13 = 0, array(1, 2), array(1))"))
    lines = r.select("*", twice.alias("nth")).withColumn("id", F.expr("if(quality = 0, '', id)"))
    whole = F.to_json(F.struct(*T.RECORD))
    root = scratch_dir(spark, "files")
    paths = default_paths(root, "typed", "scrape")
    items = T.table(spark, sf, "benchmark")

    def write_records():
        lines.select("toxic", whole.alias("line")).select(F.expr("if(toxic = 1, substr(line, 1, length(line) - 3), line)").alias("value")).write.text(paths["records"])

    def write_documents_and_manifest():
        items.select(F.concat_ws(" ", "item_id", "text")).write.option("maxRecordsPerFile", 1).text(paths["documents"])
        found = probe_hash(spark, paths["documents"]).withColumn("item", F.row_number().over(Window.orderBy("archivo")) - 1)  # a row per file
        entries = T.manifest(spark, sf).drop("seq", "archivo", "bytes", "sha256").withColumn("item", F.col("indice") % items.count())
        entries = entries.join(found, "item").drop("item").withColumns({
            "archivo": F.expr("if(indice % 7 = 0, concat('gone-', indice % 50), archivo)"),
            "bytes": F.expr("if(indice % 11 = 0, bytes + 1, bytes)"),
            "sha256": F.expr("case when indice % 5 = 1 then null when indice % 13 = 0 then reverse(sha256) else sha256 end"),
        })
        entries.write.json(paths["manifest"])

    state = spark.range(1).select(F.lit("typed").alias("fuente"), F.lit("scrape").alias("tarea"), F.lit(10).alias("pageSize"), F.lit(T.table(spark, sf, "documents").count() + 5).alias("total"), F.lit(1).alias("ultimaPagina"), F.lit(False).alias("completo"), F.lit(1).alias("registros"), F.lit("2024-01-01T00:00:00.000Z").alias("actualizadoEn"))
    together(spark, [
        write_records, write_documents_and_manifest,
        lambda: T.queue(spark, sf).write.json(paths["queue"]), lambda: state.write.json(paths["checkpoint"]),
    ])
    report, notes = validate.validate_files(spark, TYPED, 10, paths, hashed=True)
    assert not notes, notes
    return report.select("section", "check_order", "check", "level", "n")


_OWN = replace(
    TYPED, name="own", checks=(
        Check("fallo-sin-caso", "rulings do not name their case", rule=lambda: F.split_part("resolucion", F.lit("-"), F.lit(1)) != F.split_part("expediente", F.lit("-"), F.lit(2)), label=lambda: F.col("resolucion")),
        Check("caso-repetido", "records repeat a case", key=lambda: F.col("expediente"), level="aviso"),
        Check("parte-larga", "records of a source name a long unit", rule=lambda: F.length("unidadFiscalizable") + F.length("fuente") > 6),
    ),
)


@query(
    "own_checks",
    f"""WITH {S.RECORDS}, r AS (SELECT *, CASE WHEN doc_id % 17 = 0 THEN 'x' || resolucion ELSE resolucion END AS ruling FROM records) SELECT 15 AS check_order, 'fallo-sin-caso' AS "check", 'error' AS level, count(*) AS n,
        array_to_string(list(ruling ORDER BY indice)[:5], ', ') AS samples FROM r WHERE split_part(ruling, '-', 1) <> split_part(expediente, '-', 2)
      UNION ALL SELECT 16, 'caso-repetido', 'aviso', (SELECT count(*) - count(DISTINCT expediente) FROM r), (SELECT array_to_string(list(expediente ORDER BY first_at, expediente)[:5], ', ') FROM (SELECT expediente, min(indice) AS first_at FROM r GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 17, 'parte-larga', CASE WHEN count(*) > 0 THEN 'error' ELSE 'ok' END, count(*), coalesce(array_to_string(list(id ORDER BY indice)[:5], ', '), '') FROM r WHERE length(lang) + length(fuente) > 6""",
)
def _(spark, sf):
    """A third source with checks of its own: a rule on rows, a set key, and a rule that nothing breaks or everything."""
    r = T.rich_records(spark, sf).withColumn("resolucion", F.expr("if(doc_id % 17 = 0, concat('x', resolucion), resolucion)"))
    report = validate.dataset_findings(r.select(*T.RECORD), _OWN, 10)
    return report.where("check_order >= 15").select("check_order", "check", "level", "n", F.array_join("samples", ", ").alias("samples"))


@query("level_counts", f"WITH {_FACTS}, report AS ({_REPORT}) SELECT count(*) FILTER (level = 'error') AS errors, count(*) FILTER (level = 'aviso') AS warnings, count(*) FILTER (level = 'ok') AS ok, count(*) FILTER (level = 'no-evaluable') AS not_evaluable, count(*) FILTER (level = 'error') > 0 AS failed FROM report")
def _(spark, sf):
    return fnd.levels(_report(spark, sf))


@query(
    "report_text",
    f"""WITH {_FACTS}, report AS ({_REPORT}) SELECT section, check_order, '  ' || CASE level WHEN 'error' THEN '✗' WHEN 'aviso' THEN '⚠' WHEN 'ok' THEN '✓' ELSE '–' END || ' ' || rpad("check", 32, ' ') || '  ' || message ||
      CASE WHEN len(samples) > 0 THEN ' · e.g. ' || array_to_string(samples, ', ') ELSE '' END AS line FROM report""",
)
def _(spark, sf):
    return fnd.report_lines(_report(spark, sf)).select("section", "check_order", "line")


@query(
    "findings_union",
    f"""WITH {_FACTS}, report AS ({_REPORT}) SELECT section, check_order, "check", n FROM report WHERE section = 'dataset' UNION ALL
      SELECT section, check_order, "check", n FROM (SELECT 'site' AS section, 1 AS check_order, 'sitio-total' AS "check", bound AS n FROM f UNION ALL SELECT 'site', 2, 'sitio-primera-pagina', 0)""",
)
def _(spark, sf):
    r = settle(T.records(spark, sf), "records")
    total = T.table(spark, sf, "documents").count()
    dataset = validate.dataset_findings(r, TYPED, 10)
    site = validate.site_findings(r, r.where("pagina = 1"), total)
    return dataset.unionByName(site).select("section", "check_order", "check", "n")


@query("identical_in_page", f"WITH {S.PAGE_ROWS} SELECT run_id, numero, n_identical FROM repeated WHERE n_identical > 0")
def _(spark, sf):
    r = drift.repeated_in_run(T.page_rows(spark, sf))
    return r.where("n_identical > 0").select("run_id", "numero", "n_identical")


@query("misaligned_index", f"WITH {S.PAGE_ROWS} SELECT run_id, numero, min(pos) AS first_pos, count(*) AS n FROM page_rows WHERE indice <> (numero - 1) * 10 + pos GROUP BY 1, 2")
def _(spark, sf):
    return drift.misaligned_index(T.page_rows(spark, sf), (F.col("numero") - 1) * 10)


@query("page_overlap", f"WITH {S.PAGE_ROWS} SELECT run_id, numero, n_rows, n_seen, CASE WHEN n_seen = n_rows THEN 'error' ELSE 'aviso' END AS level FROM repeated WHERE n_seen > 0")
def _(spark, sf):
    return drift.page_overlap(T.page_rows(spark, sf))


@query("row_numbering", f"WITH {S.PAGE_ROWS} SELECT run_id, numero, pos, nro FROM page_rows WHERE nro <> indice + 1")
def _(spark, sf):
    return drift.misnumbered(T.page_rows(spark, sf)).select("run_id", "numero", "pos", "nro")


def _row_sign(kind, cond, level, prec):
    return f"SELECT run_id, numero, '{kind}' AS kind, '{level}' AS level, {prec} AS precedence, count(*) AS n, min(pos) AS first_pos FROM page_rows WHERE {cond} GROUP BY 1, 2"


def _page_sign(kind, cond, level, prec, n):
    return f"SELECT run_id, numero, '{kind}', '{level}', {prec}, CAST({n} AS BIGINT), CAST(NULL AS BIGINT) FROM full_pages WHERE {cond}"


def _findings(naming=False):
    base = "0" if naming else "(numero - 1) * 10"
    numbered = [] if naming else [_row_sign("numeracion", "nro <> indice + 1", "error", 8)]
    no_rows = "low < 1200 AND numero = 1" if naming else "false"
    return f"""{S.LANDED}, full_pages AS (SELECT l.*, coalesce(r.n_rows, 0) AS n_rows, r.n_identical, r.n_seen FROM landed l LEFT JOIN repeated r ON l.run_id = r.run_id AND l.numero = r.numero), found AS (""" + " UNION ALL ".join([
        _row_sign("indices-desalineados", f"indice <> {base} + pos", "error", 6),
        _row_sign("columnas", "columnas <> 7", "error", 7),
        *numbered,
        _row_sign("sin-uuid", "estado = 'ilegible'", "error", 9),
        _row_sign("registro-invalido", "NOT valid", "error", 10),
        _row_sign("sin_documento", "estado = 'sin-enlace'", "dato", 30),
        _row_sign("sin_administrado", "sin_administrado", "dato", 31),
        _row_sign("sin_expediente", "sin_expediente", "dato", 32),
        _row_sign("sin_celdas", "sin_celdas", "dato", 33),
        _page_sign("sin-iterador", no_rows, "error", 0, 1),
        _page_sign("sin-filas", f"low < 1200 AND NOT ({no_rows})", "error", 0, 1),
        _page_sign("page-size", "widget_page_size <> 10", "error", 1, "widget_page_size"),
        _page_sign("sin-total", "numero = 1 AND total IS NULL", "error", 2, 1),
        _page_sign("total-inestable", "numero = 1 AND previous_total <> total", "error", 3, "total"),
        _page_sign("sin-filas", "low >= 1200 AND n_rows = 0", "error", 4, 1),
        _page_sign("pagina-incompleta", "n_rows > 0 AND n_rows <> least(10, total - first) AND total IS NOT NULL", "error", 5, "n_rows"),
        _page_sign("solapamiento", "n_rows > 0 AND n_seen = n_rows", "error", 11, "n_rows"),
        _page_sign("filas_identicas", "n_identical > 0", "aviso", 20, "n_identical"),
        _page_sign("duplicados", "n_seen > 0 AND n_seen < n_rows", "aviso", 21, "n_seen"),
        _page_sign("cabeceras", "low BETWEEN 5000 AND 5500", "aviso", 22, 1),
        _page_sign("totales-distintos", "label_total <> total", "aviso", 23, "label_total"),
    ]) + ")"


_FINDINGS = _findings()


def _drift(spark, sf):
    return drift.page_findings(T.landed_pages(spark, sf), T.page_rows(spark, sf))


@query("drift_findings", f"WITH {_FINDINGS} SELECT * FROM found")
def _(spark, sf):
    return _drift(spark, sf)


@query("drift_findings_naming", f"WITH {_findings(naming=True)} SELECT * FROM found")
def _(spark, sf):
    return drift.page_findings(T.landed_pages(spark, sf), T.page_rows(spark, sf), numbered_per_page=True)


@query(
    "drift_first",
    f"""WITH {_FINDINGS} SELECT run_id, numero, kind FROM (SELECT *, CASE WHEN precedence BETWEEN 7 AND 10 THEN 1 WHEN precedence = 11 THEN 2 ELSE 0 END AS stage FROM found WHERE level = 'error')
      QUALIFY row_number() OVER (PARTITION BY run_id, numero ORDER BY stage, CASE WHEN stage = 1 THEN first_pos ELSE 0 END, precedence) = 1""",
)
def _(spark, sf):
    return drift.first_sign(_drift(spark, sf))
