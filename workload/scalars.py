"""Projections and predicates over the derived tables."""

from pyspark.sql import functions as F

from gleanery.functions import outcome, paging, text
from gleanery.operators.keep import capped_samples
from gleanery.plans import downloads, requestlog, resume, retry
from gleanery.sources.spec import FREE, TYPED, file_name_policy
from workload import sql as S
from workload import tables as T
from workload.registry import query


@query("normalize_ws", f"SELECT doc_id, {S.ws('text')} AS norm FROM documents")
def _(spark, sf):
    return T.table(spark, sf, "documents").select("doc_id", text.normalize_ws(F.col("text")).alias("norm"))


@query(
    "split_multivalue",
    f"""WITH {S.RECORDS} SELECT indice AS doc_id, CAST(len(administrados) AS BIGINT) AS n, array_to_string(administrados, '|') AS joined FROM records""",
)
def _(spark, sf):
    parts = text.split_multivalue(F.col("text"))
    d = T.table(spark, sf, "documents")
    return d.select("doc_id", F.size(parts).cast("bigint").alias("n"), F.array_join(parts, "|").alias("joined"))


@query("ruling_year", f"WITH {S.RECORDS} SELECT indice, resolucion, anioResolucion AS year FROM records")
def _(spark, sf):
    r = T.rich_records(spark, sf)
    return r.select("indice", "resolucion", text.ruling_year(F.col("resolucion")).alias("year"))


@query("record_id", f"WITH {S.RECORDS} SELECT indice, id FROM records")
def _(spark, sf):
    return T.rich_records(spark, sf).select("indice", TYPED.record_id().alias("id"))


@query(
    "record_id_free",
    f"""WITH {S.DOCS} SELECT indice, {S.sha24(S.ws('text') + " || ' ' || coalesce(documentoUuid, '')")} AS id FROM docs""",
)
def _(spark, sf):
    return T.free_records(spark, sf).select("indice", "id")


@query("slug", f"SELECT doc_id, {S.slug('text')} AS slug FROM documents")
def _(spark, sf):
    return T.table(spark, sf, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))


@query("document_file_name", f"WITH {S.RECORDS} SELECT indice, archivo FROM records")
def _(spark, sf):
    """A record without a document has no file."""
    return T.rich_records(spark, sf).select("indice", F.when(F.col("documentoUuid").isNotNull(), TYPED.file_name()).alias("archivo"))


@query(
    "file_name_policy",
    f"""WITH {S.RECORDS} SELECT indice, CASE WHEN lang = 'en' THEN archivo
      ELSE documentoUuid || coalesce('_' || nullif({S.slug(S.ws('text'))}, ''), '') || '.pdf' END AS archivo FROM records""",
)
def _(spark, sf):
    r = T.rich_records(spark, sf).withColumn("texto", text.normalize_ws(F.col("text")))
    langs = {lang: FREE for lang in ("de", "es", "fr")} | {"en": TYPED}
    return r.select("indice", F.when(F.col("documentoUuid").isNotNull(), file_name_policy(F.col("lang"), langs)).alias("archivo"))


@query("page_of_index", "SELECT o_orderkey, o_orderkey // 10 + 1 AS page FROM orders")
def _(spark, sf):
    return T.table(spark, sf, "orders").select("o_orderkey", paging.page_of_index(F.col("o_orderkey"), 10).alias("page"))


_TOTALS = "SELECT o_custkey, count(*) AS total FROM orders GROUP BY o_custkey"


@query("page_count", f"SELECT o_custkey, CAST(greatest(1, ceil(total / 7)) AS BIGINT) AS pages FROM ({_TOTALS})")
def _(spark, sf):
    t = T.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"))
    return t.select("o_custkey", paging.page_count(F.col("total"), 7).alias("pages"))


@query(
    "expected_rows",
    f"""WITH {S.LANDED} SELECT l.run_id, l.numero, CAST(least(10, t.total - l.first) AS BIGINT) AS expected
      FROM landed l JOIN (SELECT o_orderkey // 5000 AS run_id, count(*) AS total FROM orders GROUP BY 1) t ON l.run_id = t.run_id""",
)
def _(spark, sf):
    totals = T.table(spark, sf, "orders").groupBy(F.expr("o_orderkey div 5000").alias("run_id")).agg(F.count(F.lit(1)).alias("rows"))
    p = T.landed_pages(spark, sf).join(totals, "run_id")
    return p.select("run_id", "numero", paging.expected_rows(F.col("rows"), F.col("first"), 10).alias("expected"))


@query(
    "last_page_flag",
    f"""WITH {S.LANDED} SELECT l.run_id, l.numero, l.numero = greatest(1, ceil(t.total / 10)) AS is_last
      FROM landed l JOIN (SELECT o_orderkey // 5000 AS run_id, count(*) AS total FROM orders GROUP BY 1) t ON l.run_id = t.run_id""",
)
def _(spark, sf):
    totals = T.table(spark, sf, "orders").groupBy(F.expr("o_orderkey div 5000").alias("run_id")).agg(F.count(F.lit(1)).alias("rows"))
    p = T.landed_pages(spark, sf).join(totals, "run_id")
    return p.select("run_id", "numero", paging.is_last_page(F.col("numero"), F.col("rows"), 10).alias("is_last"))


@query(
    "schema_issues",
    f"""WITH {S.RECORDS} SELECT indice, concat_ws(' | ', CASE WHEN toxic = 1 THEN 'id: at least 1 character' END,
      CASE WHEN n_chars < 200 THEN 'pagina: integer >= 1' END, CASE WHEN lang = 'de' THEN 'resolucion: required' END,
      CASE WHEN n_chars % 250 > 210 THEN 'anioResolucion: within 1900..2100' END) AS issues FROM records""",
)
def _(spark, sf):
    r = T.rich_records(spark, sf)
    spoilt = r.withColumns(
        {
            "id": F.when(F.col("toxic") == 1, "").otherwise(F.col("id")),
            "pagina": F.when(F.col("n_chars") < 200, 0).otherwise(F.col("pagina")),
            "resolucion": F.when(F.col("lang") != "de", F.col("resolucion")),
            "anioResolucion": (F.col("n_chars") % 250 + 1890).cast("int"),
        }
    ).withColumn("anioResolucion", F.when(F.col("anioResolucion") < 1900, 1900).otherwise(F.col("anioResolucion")))
    return spoilt.select("indice", F.array_join(TYPED.issues(), " | ").alias("issues"))


def _session_urls(spark, sf):
    p = T.table(spark, sf, "pages")
    cut = F.regexp_extract("url", r"^([^?#]*)", 1)
    with_id = F.concat(cut, F.lit(";JSESSIONID="), F.col("page_id").cast("string"), F.substr("url", F.length(cut) + 1))
    return p.select("page_id", with_id.alias("url"))


_WITH_ID = "(SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) || ';JSESSIONID=' || page_id || substr(url, length(regexp_extract(url, '^([^?#]*)', 1)) + 1) AS url FROM pages)"


@query("strip_session_url", f"SELECT page_id, regexp_replace(url, '(?i);jsessionid=[^?/;]*', '') AS url FROM {_WITH_ID}")
def _(spark, sf):
    return _session_urls(spark, sf).select("page_id", text.strip_session_url(F.col("url")).alias("url"))


@query(
    "redact_url",
    f"""SELECT page_id, regexp_replace(url, '(?i);jsessionid=[^?#/\\s]*', ';jsessionid=REDACTED', 'g') AS url,
      '[REDACTED]' AS cookie, 'p' || page_id AS agent FROM {_WITH_ID}""",
)
def _(spark, sf):
    u = _session_urls(spark, sf)
    agent = F.concat(F.lit("p"), F.col("page_id").cast("string"))
    heads = text.redact_cookies(F.create_map(F.lit("Cookie"), F.col("url"), F.lit("agent"), agent))
    return u.select("page_id", text.redact_url(F.col("url")).alias("url"), heads["Cookie"].alias("cookie"), heads["agent"].alias("agent"))


@query("status_class", f"WITH {S.LOG} SELECT event_id, kind AS outcome FROM classified")
def _(spark, sf):
    return T.log(spark, sf).select("event_id", outcome.status_class(F.col("status"), F.col("net_code")).alias("outcome"))


@query("class_flags", f"WITH {S.LOG} SELECT event_id, retryable, degrades FROM classified")
def _(spark, sf):
    return requestlog.classify(T.log(spark, sf)).select("event_id", "retryable", "degrades")


@query(
    "retry_after_ms",
    f"""WITH {S.LOG} SELECT event_id, CAST(CASE WHEN regexp_full_match(retry_after, '\\d+') THEN TRY_CAST(retry_after AS BIGINT) * 1000
      WHEN k = 0 THEN greatest(0, datesub('millisecond', ts, date_trunc('second', ts + INTERVAL 90 SECOND))) END AS BIGINT) AS wait_ms FROM log""",
)
def _(spark, sf):
    return T.log(spark, sf).select("event_id", outcome.retry_after_ms(F.col("retry_after"), F.col("ts")).alias("wait_ms"))


def _bodies(spark, sf):
    d = T.documents(spark, sf)
    return d.select("doc_id", F.concat(F.when(F.col("labelled"), "%PDF-1.7\n").otherwise(""), "text").cast("binary").alias("content"))


_PROBLEM = """(SELECT doc_id, CASE WHEN body NOT LIKE '\\%PDF-%' ESCAPE '\\' THEN 'magic' WHEN octet_length(encode(body)) < 1024 THEN 'tamano' END AS problem
  FROM (SELECT doc_id, CASE WHEN labelled THEN '%PDF-1.7' || chr(10) ELSE '' END || text AS body FROM docs))"""


@query("file_validity", f"WITH {S.DOCS} SELECT doc_id, problem FROM {_PROBLEM}")
def _(spark, sf):
    b = _bodies(spark, sf)
    return b.select("doc_id", outcome.file_problem(F.col("content"), F.octet_length("content")).alias("problem"))


@query(
    "failure_code",
    f"""WITH {S.LOG} SELECT event_id, CASE WHEN kind = 'ok' AND latency_ms < 5 THEN 'documento-magic' WHEN kind = 'ok' AND latency_ms < 10 THEN 'documento-tamano'
      WHEN kind <> 'ok' THEN kind END AS code FROM classified""",
)
def _(spark, sf):
    c = requestlog.classify(T.log(spark, sf))
    problem = F.expr("case when outcome = 'ok' and latency_ms < 5 then 'magic' when outcome = 'ok' and latency_ms < 10 then 'tamano' end")
    return c.select("event_id", outcome.failure_code(problem, F.col("outcome")).alias("code"))


@query("thousands", f"SELECT o_orderkey, {S.thousands('floor(o_totalprice)')} AS shown FROM orders")
def _(spark, sf):
    return T.table(spark, sf, "orders").select("o_orderkey", text.thousands(F.floor("o_totalprice")).alias("shown"))


@query("page_range", f"WITH {S.RECORDS} SELECT indice, pagina FROM records WHERE pagina BETWEEN 3 AND (SELECT max(pagina) FROM records)")
def _(spark, sf):
    r = T.records(spark, sf)
    last = r.agg(F.max("pagina")).first()[0]
    return resume.in_page_range(r, last, 3, last + 1000).select("indice", "pagina")


@query("record_predicate", f"WITH {S.RECORDS} SELECT indice, id FROM records WHERE id IN (SELECT id FROM records WHERE quality = 1) AND lang <> 'de'")
def _(spark, sf):
    r = T.rich_records(spark, sf)
    wanted = r.where("quality = 1").select("id").distinct()
    return r.where("lang <> 'de'").join(wanted, "id", "left_semi").select("indice", "id")


@query("has_document", f"WITH {S.RECORDS} SELECT indice, documentoUuid FROM records WHERE documentoUuid <> ''")
def _(spark, sf):
    return T.records(spark, sf).where(downloads.HAS_DOCUMENT).select("indice", "documentoUuid")


@query("retryable_entries", f"WITH {S.QUEUE} SELECT id, seq, intentos FROM latest WHERE tipo = 'pdf' AND intentos < 5")
def _(spark, sf):
    return retry.retryable_entries(retry.collapse(T.queue(spark, sf))).select("id", "seq", "intentos")


@query(
    "blank_field",
    f"WITH {S.RECORDS} SELECT indice, trim(sector) = '' AS sector_blank, len(administrados) = 0 AS parties_blank FROM records",
)
def _(spark, sf):
    r = T.records(spark, sf)
    return r.select("indice", text.is_blank(F.col("sector")).alias("sector_blank"), text.is_blank_list(F.col("administrados")).alias("parties_blank"))


@query(
    "capped_samples",
    f"""WITH {S.RECORDS} SELECT unidadFiscalizable AS unit, count(*) AS n,
      array_to_string(list_transform(list_slice(list_sort(list(indice)), 1, 5), lambda i: CAST(i AS VARCHAR)), ',') AS samples
      FROM records WHERE anioResolucion IS NULL GROUP BY 1""",
)
def _(spark, sf):
    off = T.records(spark, sf).where("anioResolucion is null").withColumnRenamed("unidadFiscalizable", "unit")
    s = capped_samples(off, "unit", F.col("indice").cast("string"), [F.col("indice")])
    return s.select("unit", "n", F.array_join("samples", ",").alias("samples"))


@query(
    "top_samples",
    f"""WITH {S.RECORDS} SELECT fuente, indice, id FROM records QUALIFY row_number() OVER (PARTITION BY fuente ORDER BY indice) <= 5""",
)
def _(spark, sf):
    from gleanery.operators.keep import MAX_SAMPLES, first_k

    return first_k(T.records(spark, sf).select("fuente", "indice", "id"), ["fuente"], [F.col("indice")], MAX_SAMPLES)
