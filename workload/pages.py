"""Extraction from landed bodies."""

from pyspark.sql import functions as F

from gleanery.functions import markup
from gleanery.plans import drift, extract
from gleanery.sources import responses as resp
from workload import tables as T
from workload.registry import query

_PART = """part_rows AS (SELECT p_partkey // 10 AS page_id, p_partkey % 10 AS pos, p_partkey AS indice, p_partkey + 1 AS nro, CASE WHEN p_size = 10 THEN 6 ELSE 7 END AS columnas,
  CASE WHEN p_size <> 10 THEN p_brand END AS expediente, CASE WHEN p_size <> 10 THEN p_name || '|' || p_type END AS administrados, CASE WHEN p_size <> 10 THEN p_type END AS unidad,
  CASE WHEN p_size <> 10 THEN CAST(p_size AS VARCHAR) END AS sector, CASE WHEN p_size <> 10 THEN p_size || '-' || (1880 + p_size * 5) || '-X' END AS resolucion,
  CASE WHEN p_size <> 10 AND 1880 + p_size * 5 BETWEEN 1900 AND 2100 THEN 1880 + p_size * 5 END AS anio,
  CASE WHEN p_size < 5 THEN 'sin-enlace' WHEN p_size > 45 THEN 'ilegible' ELSE 'ok' END AS estado, CASE WHEN p_size BETWEEN 5 AND 45 THEN 'd-' || p_partkey END AS uuid FROM part)"""


def _typed(spark, sf):
    return extract.typed_rows(extract.page_parts(T.table_pages(spark, sf), "body", ["indexed_rows"]))


@query("extract_rows_index", f"WITH {_PART} SELECT page_id, pos, indice, nro, columnas, expediente, administrados, unidad, sector, resolucion, anio, estado FROM part_rows")
def _(spark, sf):
    return _typed(spark, sf).select(
        "page_id", "pos", "indice", "nro", "columnas", "expediente", F.array_join("administrados", "|").alias("administrados"),
        F.col("unidadFiscalizable").alias("unidad"), "sector", "resolucion", F.col("anioResolucion").alias("anio"), "documento.estado",
    )


@query(
    "extract_typed_records",
    f"""WITH {_PART} SELECT indice, page_id + 1 AS pagina, uuid AS document, substr(sha1(concat_ws(chr(0), expediente, administrados, unidad, sector, resolucion, coalesce(uuid, ''))), 1, 24) AS id
      FROM part_rows WHERE columnas = 7""",
)
def _(spark, sf):
    when = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    r = extract.typed_records(_typed(spark, sf), "typed", F.col("page_id") + 1, when)
    return r.select("indice", "pagina", F.col("documentoUuid").alias("document"), "id")


_SUPP = """supp AS (SELECT s_suppkey // 10 AS page_id, s_suppkey % 10 AS indice, 'list' AS iterador, s_name || s_nationkey || ' & co' AS texto, s_name || '|' || s_nationkey || ' & co|' AS celdas,
  CASE WHEN s_acctbal < 0 THEN 'sin-enlace' ELSE 'ok' END AS estado, CASE WHEN s_acctbal >= 0 THEN 's-' || s_suppkey END AS uuid, s_name, s_nationkey FROM supplier)"""


def _named(spark, sf):
    return extract.free_rows(extract.page_parts(T.named_pages(spark, sf), "body", ["named_rows", "headers"]))


@query("extract_rows_naming", f"WITH {_SUPP} SELECT page_id, indice, iterador, s_name || ' ' || s_nationkey || ' & co' AS texto, celdas, estado, uuid FROM supp")
def _(spark, sf):
    return _named(spark, sf).select("page_id", "indice", "iterador", "texto", F.array_join("celdas", "|").alias("celdas"), "documento.estado", "documento.uuid")


@query("label_cells", f"WITH {_SUPP} SELECT page_id, indice, s_name AS name, s_nationkey || ' & co' AS second, '' AS third, 3 AS n FROM supp")
def _(spark, sf):
    c = F.col("campos")
    return _named(spark, sf).select("page_id", "indice", c["Name"].alias("name"), c["columna2"].alias("second"), c["columna3"].alias("third"), F.size(c).alias("n"))


@query(
    "extract_free_records",
    f"WITH {_SUPP} SELECT page_id * 10 + indice AS indice, substr(sha1(s_name || ' ' || s_nationkey || ' & co' || ' ' || coalesce(uuid, '')), 1, 24) AS id FROM supp",
)
def _(spark, sf):
    when = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    return extract.free_records(_named(spark, sf), "free", F.col("page_id") + 1, F.col("page_id") * 10, when).select("indice", "id")


@query("headers", "SELECT DISTINCT p_partkey // 10 AS page_id, 'No|Case|Party|Unit|Sector|Ruling|File' AS headers FROM part")
def _(spark, sf):
    from gleanery.functions.text import normalize_ws

    h = extract.page_parts(T.table_pages(spark, sf), "body", ["headers"])
    return h.select("page_id", F.array_join(F.transform("headers", normalize_ws), "|").alias("headers"))


_PAGES = "SELECT p_partkey // 10 AS page_id, min(p_size) AS low, count(*) AS n FROM part GROUP BY 1"


@query("widget_total", f"SELECT page_id, page_id * 7 AS total FROM ({_PAGES})")
def _(spark, sf):
    return T.table_pages(spark, sf).select("page_id", markup.widget_total(F.col("body")).alias("total"))


@query("widget_page_size", f"SELECT page_id, CAST(10 AS BIGINT) AS page_size FROM ({_PAGES})")
def _(spark, sf):
    return T.table_pages(spark, sf).select("page_id", markup.widget_page_size(F.col("body")).alias("page_size"))


@query("paginator_label", f"SELECT page_id, page_id + 1 AS page, CAST(1760 AS BIGINT) AS pages, CAST(17593 AS BIGINT) AS total FROM ({_PAGES})")
def _(spark, sf):
    p = extract.page_parts(T.table_pages(spark, sf), "body", ["paginator_text"])
    return p.select("page_id", markup.paginator_label(F.col("paginator_text")).alias("l")).select("page_id", "l.*")


@query("text_total", "SELECT DISTINCT s_suppkey // 10 AS page_id, s_suppkey // 10 * 1000 + 1753 AS total FROM supplier")
def _(spark, sf):
    p = extract.page_parts(T.named_pages(spark, sf), "body", ["page_text"])
    return p.select("page_id", markup.text_total(F.col("page_text")).alias("total"))


@query("empty_table_flag", f"SELECT page_id, low < 3 AS is_empty FROM ({_PAGES})")
def _(spark, sf):
    return T.table_pages(spark, sf).select("page_id", markup.is_empty_table(F.col("body")).alias("is_empty"))


@query("row_indices", "SELECT p_partkey // 10 AS page_id, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS indices FROM part GROUP BY 1")
def _(spark, sf):
    return T.table_pages(spark, sf).select("page_id", F.array_join(markup.row_indices(F.col("body")).cast("array<string>"), ",").alias("indices"))


_CLICK = """concat('return x(), mojarra.jsfcljs(document.getElementById(\\'f', c_nationkey, '\\'),{', if(c_acctbal < 0, '', concat('\\'a:b\\':\\'a:b\\',\\'seg\\':\\'', c_mktsegment, '\\\\\\'s\\'')), '},\\'\\')')"""


def _clicks(spark, sf):
    return T.table(spark, sf, "customer").select("c_custkey", F.expr(_CLICK).alias("onclick"))


@query(
    "click_command",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'f' || c_nationkey END AS form_id, CASE WHEN c_acctbal >= 0 THEN 'a:b=a:b,seg=' || c_mktsegment || '''s' END AS params FROM customer",
)
def _(spark, sf):
    c = _clicks(spark, sf).withColumn("c", markup.click_command(F.col("onclick")))
    pairs = F.transform(F.array_sort(F.map_entries("c.params")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return c.select("c_custkey", "c.form_id", F.array_join(pairs, ",").alias("params"))


@query(
    "document_link",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'ok' ELSE 'ilegible' END AS estado, CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '''s' END AS uuid FROM customer",
)
def _(spark, sf):
    c = _clicks(spark, sf).withColumn("command", markup.click_command(F.col("onclick")))
    return c.select("c_custkey", markup.document_link(F.col("onclick"), F.col("command")).alias("d")).select("c_custkey", "d.estado", "d.uuid")


@query(
    "partial_xml_scan",
    """SELECT p_partkey AS resp_id, p_size >= 5 AS es_partial, CASE WHEN p_size >= 14 THEN 3 ELSE 0 END AS n_updates, CASE WHEN p_size >= 14 THEN 'f:dt|x:g:list|j1:javax.faces.ViewState:0' ELSE '' END AS ids,
      CASE WHEN p_size >= 14 THEN p_partkey || ':5' END AS token, CASE WHEN p_size BETWEEN 5 AND 8 THEN '/home?' || p_partkey END AS redirect,
      CASE WHEN p_size BETWEEN 9 AND 11 THEN p_brand END AS error_name, CASE WHEN p_size BETWEEN 9 AND 11 THEN p_type END AS error_message FROM part""",
)
def _(spark, sf):
    p = resp.partial_responses(T.responses(spark, sf))
    return p.select(
        "resp_id", "es_partial", F.size("updates").alias("n_updates"), F.array_join(F.transform("updates", lambda u: u["id"]), "|").alias("ids"),
        "token", "redirect", F.col("error.name").alias("error_name"), F.col("error.message").alias("error_message"),
    )


@query(
    "find_update",
    "SELECT p_partkey AS resp_id, CASE WHEN p_size >= 14 THEN '<tr>' || p_name || '</tr>' END AS exact, CASE WHEN p_size >= 14 THEN p_type END AS nested FROM part",
)
def _(spark, sf):
    p = resp.partial_responses(T.responses(spark, sf))
    return p.select("resp_id", resp.find_update(F.col("updates"), "f:dt").alias("exact"), resp.find_update(F.col("updates"), "list").alias("nested"))


@query(
    "expired_view",
    "SELECT p_partkey AS resp_id, CASE WHEN p_size < 5 THEN 'not-partial' WHEN p_size < 9 THEN 'expired-redirect' WHEN p_size < 12 THEN 'expired-error' ELSE 'partial' END AS class FROM part",
)
def _(spark, sf):
    return resp.partial_responses(T.responses(spark, sf)).select("resp_id", resp.response_class().alias("class"))


_LINKS = "SELECT page_id, regexp_extract(h, 'href=\"([^\"]*)\"', 1) AS href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"[^\"]*\"[^>]*>')) AS h FROM pages)"


@query("page_links", f"SELECT page_id, count(href) AS n, coalesce(string_agg(DISTINCT href, ' ' ORDER BY href), '') AS hrefs FROM pages LEFT JOIN ({_LINKS}) USING (page_id) GROUP BY page_id")
def _(spark, sf):
    p = extract.page_parts(extract.spread(T.table(spark, sf, "pages"), "page_id"), "html", ["controls"])
    links = F.transform(F.filter("controls", lambda c: (c["tag"] == "a") & c["href"].isNotNull()), lambda c: c["href"])
    return p.select("page_id", F.size(links).cast("bigint").alias("n"), F.array_join(F.array_sort(F.array_distinct(links)), " ").alias("hrefs"))


@query("pages_scan", "SELECT page_id, url, CAST(length(html) AS INT) AS chars FROM pages")
def _(spark, sf):
    return T.table(spark, sf, "pages").select("page_id", "url", F.length("html").alias("chars"))


@query(
    "form_fields",
    """WITH f AS (SELECT c_custkey AS page_id, 'f' || c_custkey AS form_id, 'http://h.example/list?q=1' AS action, c_acctbal >= 0 AS has_token, * FROM customer)
      SELECT page_id, form_id, action, has_token, 'f:q' AS name, c_mktsegment || '|' || c_name AS "values" FROM f UNION ALL SELECT page_id, form_id, action, has_token, 'f:nation', CAST(c_nationkey AS VARCHAR) FROM f
      UNION ALL SELECT page_id, form_id, action, has_token, 'f:on', '1' FROM f WHERE c_acctbal > 5000""",
)
def _(spark, sf):
    p = extract.page_parts(T.form_pages(spark, sf), "body", ["forms"], "url").drop("url")
    return extract.form_fields(p).withColumn("values", F.array_join("values", "|"))


@query("labelled_control", "SELECT c_custkey AS page_id, CASE WHEN c_mktsegment <> 'BUILDING' THEN ' Buscar ' END AS label, CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) END AS go FROM customer")
def _(spark, sf):
    p = extract.page_parts(T.form_pages(spark, sf).drop("url"), "body", ["controls"])
    found = extract.labelled_control(p, extract.SEARCH_LABEL)
    return found.select("page_id", "label", F.try_element_at("command.params", F.lit("go")).alias("go"))


@query("discovery_signs", "SELECT c_custkey AS page_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'busqueda-no-descubierta' ELSE 'paginacion-no-descubierta' END AS kind FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal > 0")
def _(spark, sf):
    p = extract.page_parts(T.form_pages(spark, sf).drop("url"), "body", ["controls"])
    both = extract.labelled_commands(p, {"search": extract.SEARCH_LABEL, "next": extract.NEXT_LABEL}).join(T.table(spark, sf, "customer").select(F.col("c_custkey").alias("page_id"), "c_acctbal"), "page_id")
    signs = drift.discovery_signs(both.select("page_id", F.lit(True).alias("needs_search"), (F.col("c_acctbal") > 0).alias("needs_next"), "search", "next"))
    return signs.select("page_id", "kind")


@query("token_shape", "SELECT c_custkey AS page_id, c_acctbal >= 0 AS present, CASE WHEN c_acctbal >= 0 THEN CAST(length(c_custkey || ':77') AS INT) END AS length FROM customer")
def _(spark, sf):
    p = extract.page_parts(T.form_pages(spark, sf).drop("url"), "body", ["page_token"])
    return p.select("page_id", markup.token_shape(F.col("page_token")).alias("t")).select("page_id", "t.*")


@query("form_recognised", "SELECT c_custkey AS page_id, c_acctbal > 5000 AS recognised, true AS bare FROM customer")
def _(spark, sf):
    p = extract.page_parts(T.form_pages(spark, sf), "body", ["forms"], "url")
    names = F.flatten(F.transform("forms", lambda f: F.transform(f["fields"], lambda x: x["name"])))
    return p.select("page_id", markup.form_recognised(names, ["on", "year"]).alias("recognised"), markup.form_recognised(names, ["f:q"]).alias("bare"))


@query("page_order", "SELECT page_id, string_agg(CAST(indice AS VARCHAR), ',' ORDER BY indice) AS indices FROM (SELECT s_suppkey // 10 AS page_id, s_suppkey % 10 AS indice FROM supplier) GROUP BY 1")
def _(spark, sf):
    # Rows come out by number although the markup has them the other way round.
    p = extract.page_parts(T.named_pages(spark, sf), "body", ["named_rows"])
    return p.select("page_id", F.array_join(F.transform("named_rows", lambda r: r["number"].cast("string")), ",").alias("indices"))
