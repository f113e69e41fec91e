"""Harvest tables derived from the given ones: the inputs of the registered queries.

Each function has its DuckDB counterpart of the same name in ``workload/sql.py``. Faults
(blank fields, orphans, other sizes, broken links) follow from the rows' own values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import normalize_ws, ruling_year, split_multivalue
from gleanery.plans.extract import spread
from gleanery.plans.requestlog import attempts, classify
from gleanery.sources.spec import FREE, TYPED

RECORD = [f.name for f in TYPED.schema.fields]
NARROW = [c for c in RECORD if c != "administrados"]  # the parties hold the whole text of a document


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels; a labelled one has a file, which is lost where it is toxic and names another document where quality is low.

    Texts are hashed before the join, so that what needs a digest only does not carry them through it."""
    digest = F.substring(F.sha1(F.col("text").cast("binary")), 1, 24)
    labels = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("labelled"), "toxic", "quality")
    joined = table(spark, sf, "documents").withColumn("digest", digest).join(labels, "doc_id", "left")
    return joined.withColumns({"labelled": F.coalesce("labelled", F.lit(False)), "documentoUuid": F.when(F.col("labelled"), F.col("digest"))}).drop("digest")


def _by_page(rows: DataFrame, page):
    """Group by page in as many tasks as shuffles have: small as the bodies may be, reading
    them is heavy, so the tasks should not be merged by size."""
    return spread(rows.withColumn("page_id", page), "page_id").groupBy("page_id")


def _base(d: DataFrame) -> DataFrame:
    return d.select(
        "*",
        F.col("source").alias("fuente"),
        F.col("doc_id").alias("indice"),
        F.expr("doc_id div 10 + 1 + coalesce(toxic, 0)").cast("bigint").alias("pagina"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)").alias("capturadoEn"),
    )


def rich_records(spark: SparkSession, sf: str) -> DataFrame:
    """Typed records, with the columns they came from."""
    rows = _base(documents(spark, sf)).withColumns(
        {
            "expediente": F.concat_ws("-", "lang", F.col("n_chars").cast("string")),
            "administrados": split_multivalue(F.col("text")),
            "unidadFiscalizable": F.col("lang"),
            "sector": F.when(F.col("n_chars") % 97 == 0, " ").otherwise(F.concat(F.lit("S"), (F.col("n_chars") % 20).cast("string"))),
            "resolucion": F.concat_ws("-", F.col("n_chars").cast("string"), (F.col("n_chars") % 250 + 1890).cast("string"), F.upper("lang")),
        }
    )
    rows = rows.withColumn("anioResolucion", ruling_year(F.col("resolucion")))
    return rows.withColumn("id", TYPED.record_id())


def records(spark: SparkSession, sf: str) -> DataFrame:
    return rich_records(spark, sf).select(*RECORD)


def free_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = _base(documents(spark, sf)).withColumns(
        {"campos": F.create_map("lang", "source"), "texto": normalize_ws(F.col("text"))}
    )
    return rows.withColumn("id", FREE.record_id()).select(*[f.name for f in FREE.schema.fields])


def harvest(spark: SparkSession, sf: str) -> DataFrame:
    """Records with what their files hold: the base of manifest and disk, without the texts."""
    text = F.col("text")
    on_disk = F.when(F.col("source") == "src3", F.concat(text, F.lit("!"))).otherwise(text)
    return rich_records(spark, sf).select(
        *NARROW, "lang", "n_chars", "quality", "toxic", "labelled",
        TYPED.file_name().alias("archivo"),
        F.octet_length(text).cast("bigint").alias("file_bytes"),
        F.sha2(text.cast("binary"), 256).alias("sha256"),
        F.sha2(on_disk.cast("binary"), 256).alias("disk_sha256"),
    )


def manifest(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    """One entry per labelled record; toxic ones lost their record, those of low quality name another document."""
    lost = F.substring(F.sha1(F.concat(F.lit("lost:"), "id").cast("binary")), 1, 24)
    return (harvest(spark, sf) if base is None else base).where("labelled").select(
        F.when(F.col("toxic") == 1, lost).otherwise(F.col("id")).alias("id"),
        "fuente",
        F.when(F.col("quality") == 0, F.reverse("documentoUuid")).otherwise(F.col("documentoUuid")).alias("documentoUuid"),
        "pagina",
        "indice",
        "archivo",
        F.col("n_chars").alias("bytes"),
        "sha256",
        F.lit(None).cast("string").alias("nombreServidor"),
        F.col("capturadoEn").alias("descargadoEn"),
        F.col("indice").alias("seq"),
    )


def probe(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    """Files on disk: none for German documents, other content for those of one source."""
    files = (harvest(spark, sf) if base is None else base).where("labelled and lang <> 'de'")
    return files.groupBy("archivo").agg(F.max("file_bytes").alias("bytes"), F.max("disk_sha256").alias("sha256"))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """Request log. ``k`` (0..99) of an event decides what became of its request."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    late = F.concat(F.lit("Mon, "), F.date_format(F.expr("ts + interval 90 seconds"), "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return e.withColumn("k", k).select(
        "event_id",
        "ts",
        F.col("user_id").alias("session"),
        F.col("event_type").alias("request"),
        F.expr("case when k < 5 then 429 when k < 8 then 403 when k < 15 then 503 when k < 20 then 404 when k < 97 then 200 end").alias("status"),
        F.expr("case k when 97 then 'ECONNRESET' when 98 then 'ECONNREFUSED' end").alias("net_code"),
        F.when(F.col("k") == 0, late).when(F.col("k") == 1, "soon").when(F.col("k") < 5, F.col("k").cast("string")).alias("retry_after"),
        F.col("value").alias("latency_ms"),
        "k",
    )


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify(attempts(log(spark, sf), ["session", "request"]))


def downloads(spark: SparkSession, sf: str) -> DataFrame:
    """Downloads of a session: good, invalid or failed otherwise."""
    return log(spark, sf).select(
        "session", "ts", "event_id", F.expr("case when k >= 40 then 'ok' when k < 25 then 'invalid' else 'failed' end").alias("result")
    )


def queue(spark: SparkSession, sf: str) -> DataFrame:
    """Failure queue: one entry per error event, several per user."""
    e = classify(log(spark, sf)).where("request = 'error'")
    page = F.expr("case when k < 95 then cast(k as string) end")
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("u"), F.col("session").cast("string")).alias("id"),
        F.when(F.col("latency_ms") < 1, "page").otherwise("pdf").alias("tipo"),
        F.when(F.col("outcome") == "ok", "documento-magic").otherwise(F.col("outcome")).alias("error"),
        F.expr("cast(k div 15 as int)").alias("intentos"),
        F.col("ts").alias("ultimoTs"),
        F.lit("as logged").alias("detalle"),
        F.create_map(F.lit("pagina"), page).alias("contexto"),
    )


def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as a portal would have shown them, ten orders to a page, five hundred pages to a run."""
    o = table(spark, sf, "orders")
    return o.select(
        F.expr("o_orderkey div 5000").alias("run_id"),
        F.expr("(o_orderkey % 5000) div 10 + 1").alias("numero"),
        F.expr("o_orderkey % 10").alias("pos"),
        F.expr("o_orderkey % 5000 + if(o_totalprice > 497000, 1, 0)").alias("indice"),
        F.expr("o_orderkey % 5000 + 1 + if(o_totalprice between 3000 and 4000, 1, 0)").alias("nro"),
        F.expr("if(o_totalprice < 2000, 6, 7)").alias("columnas"),
        F.expr("case when o_totalprice between 2000 and 3000 then 'ilegible' when o_orderstatus = 'P' then 'sin-enlace' else 'ok' end").alias("estado"),
        F.substring(F.sha1(F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderpriority").cast("binary")), 1, 24).alias("id"),
        F.expr("o_totalprice not between 4000 and 4500").alias("valid"),
        F.expr("o_custkey % 50 = 0").alias("sin_administrado"),
        F.expr("o_custkey % 51 = 0").alias("sin_expediente"),
        F.expr("o_custkey % 97 = 0").alias("sin_celdas"),
    )


def landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages of :func:`page_rows`, with what their widgets declare."""
    o = table(spark, sf, "orders")
    p = o.groupBy(F.expr("o_orderkey div 5000").alias("run_id"), F.expr("(o_orderkey % 5000) div 10 + 1").alias("numero")).agg(
        F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low")
    )
    heads = F.array(*[F.lit(h) for h in ("No", "Case", "Parties")])
    return p.select(
        "run_id",
        "numero",
        F.expr("(numero - 1) * 10").alias("first"),
        F.expr("case run_id % 3 when 0 then 5000L when 2 then 4995L end").alias("total"),
        F.lit(10).cast("bigint").alias("page_size"),
        F.expr("if(top > 498000, 20L, 10L)").alias("widget_page_size"),
        (F.col("numero") == 1).alias("is_search"),
        F.expr("if(run_id > 0, 4999L + run_id % 2, null)").alias("previous_total"),
        F.expr("if(low < 2500, 4999L, 5000L)").alias("label_total"),
        F.expr("low >= 1200").alias("has_component"),
        F.lit(False).alias("marked_empty"),
        F.when(F.col("low").between(5000, 5500), F.array(F.lit("No"), F.lit("Case"))).otherwise(heads).alias("headers"),
        heads.alias("expected_headers"),
    )


def _row_markup() -> str:
    link = """case when p_size < 5 then ''
      when p_size > 45 then '<a href="#" onclick="open(1)">pdf</a>'
      else concat('<a href="#" onclick="mojarra.jsfcljs(document.getElementById(\\'f\\'),{\\'f:dt:', p_partkey, ':j\\':\\'f:dt:', p_partkey, ':j\\',\\'doc\\':\\'d-', p_partkey, '\\'},\\'\\');return false">pdf</a>') end"""
    return f"""concat('<tr data-ri="', p_partkey, '"><td>', p_partkey + 1, '</td><td> ', p_brand, ' </td><td>', p_name, '\\n  ', p_type,
      '\\n</td><td>', p_type, '</td><td>', p_size, '</td>', if(p_size = 10, '', concat('<td>', p_size, '-', 1880 + p_size * 5, '-X</td>')), '<td>', {link}, '</td></tr>')"""


HEADERS = ("No", "Case", "Party", "Unit", "Sector", "Ruling", "File")


def table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as pages of a result table, ten rows each; a page holds no more than that."""
    p = table(spark, sf, "part").withColumn("row", F.expr(_row_markup()))
    pages = _by_page(p, F.expr("p_partkey div 10")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "row"))), lambda r: r["row"]), "").alias("rows"),
        F.min("p_size").alias("low"),
    )
    head = "<table><thead><tr>" + "".join(f"<th> {h} </th>" for h in HEADERS) + "</tr></thead><tbody>"
    foot = F.concat(
        F.lit("</tbody></table><span class=\"x ui-paginator-current\">Página "), (F.col("page_id") + 1).cast("string"),
        F.lit(" de 1.760 (17.593 registros)</span><script>w({paginator:{id:['p'],rows:10},rowCount:"), (F.col("page_id") * 7).cast("string"), F.lit("})</script>"),
        F.when(F.col("low") < 3, "<div class=\"ui-datatable-empty-message\"></div>").otherwise(""),
    )
    return pages.select("page_id", F.concat(F.lit(head), "rows", foot).alias("body"))


def named_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as pages of a naming-container list: rows are known by ``form:list:N:part`` ids."""
    s = table(spark, sf, "supplier").withColumn("n", F.expr("s_suppkey % 10"))
    row = F.expr("""concat('<tr><td><span id="f:list:', n, ':a">', s_name, '</span></td><td id="f:list:', n, ':b"> ', s_nationkey, ' &amp; co</td><td>',
      if(s_acctbal < 0, '', concat('<input type="button" onclick="mojarra.jsfcljs(document.getElementById(\\'f\\'),{\\'f:b\\':\\'f:b\\',\\'uuid\\':\\'s-', s_suppkey, '\\'},\\'\\')">')), '</td></tr>')""")
    pages = _by_page(s.withColumn("row", row), F.expr("s_suppkey div 10")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "row")), asc=False), lambda r: r["row"]), "").alias("rows"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return pages.select(
        "page_id",
        F.concat(
            F.lit("<p>Se encontraron "), (F.col("page_id") * 1000 + 1753).cast("string"), F.lit(" resultados</p><table><thead><tr><th>Name</th><th></th></tr></thead><tbody>"),
            "rows", F.lit("</tbody></table>"),
        ).alias("body"),
    )


def form_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as pages with a search form, whose fields depend on the customer."""
    body = F.expr("""concat('<form id="f', c_custkey, '" action="/list;jsessionid=A1', c_custkey, '?q=1"><input name="f:q" value="', c_mktsegment, '">',
      '<input type="checkbox" name="f:on" value="1"', if(c_acctbal > 5000, ' checked', ''), '><input type="submit" name="f:go" value="Go">',
      '<select name="f:nation"><option value="0">none</option><option value="', c_nationkey, '" selected>n</option></select>',
      '<textarea name="f:q">', c_name, '</textarea><input name="f:off" disabled value="x">',
      if(c_acctbal < 0, '', concat('<input type="hidden" name="javax.faces.ViewState" value="', c_custkey, ':77">')),
      '<button onclick="open(1)">Buscar</button><a onclick="mojarra.jsfcljs(document.getElementById(\\'f\\'),{\\'go\\':\\'', c_custkey, '\\'},\\'\\')" title="',
      if(c_mktsegment = 'BUILDING', 'Other', ' Buscar '), '">x</a></form>')""")
    customers = spread(table(spark, sf, "customer"), "c_custkey")
    return customers.select(F.col("c_custkey").alias("page_id"), F.lit("http://h.example/a/b").alias("url"), body.alias("body"))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as partial-XML responses: updates, expired views, whole pages and broken envelopes."""
    body = F.expr("""case
      when p_size < 5 then concat('<html><body>', p_name, '</body></html>')
      when p_size < 9 then concat('<?xml version="1.0"?><partial-response><redirect url="/home?', p_partkey, '"/></partial-response>')
      when p_size < 12 then concat('<partial-response><error><error-name>', p_brand, '</error-name><error-message><![CDATA[', p_type, ']]></error-message></error></partial-response>')
      when p_size < 14 then concat('<partial-response><changes><update id="f:dt">', p_name)
      else concat('<?xml version="1.0" encoding="UTF-8"?>\\n<partial-response id="p"><changes><update id="f:dt"><![CDATA[<tr>', p_name, '</tr>]]></update><update id="x:g:list"><![CDATA[', p_type,
        ']]></update><update id="j1:javax.faces.ViewState:0"><![CDATA[', p_partkey, ':5]]></update></changes></partial-response>') end""")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("resp_id"), body.alias("body"))


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Resume state per customer and task."""
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey"),
        F.col("c_mktsegment").alias("fuente"),
        F.when(F.col("c_nationkey") < 3, "download").otherwise("scrape").alias("tarea"),
        F.when(F.col("c_nationkey") == 4, 20).otherwise(10).alias("pageSize"),
        F.expr("cast(abs(c_acctbal) as bigint)").alias("total"),
        F.expr("cast(c_custkey % 700 as int)").alias("ultimaPagina"),
        F.expr("case when c_nationkey > 20 then true when c_nationkey > 15 then false end").alias("completo"),
        F.col("c_custkey").alias("registros"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("actualizadoEn"),
    )


def resume_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer, what a run asks for; those with small balances never ran before."""
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.col("c_mktsegment").alias("fuente"),
        F.lit("scrape").alias("tarea"),
        F.when(F.col("c_nationkey") == 5, 0).otherwise(10).alias("page_size"),
        F.expr("if(c_nationkey = 6, 3L, null)").alias("desde"),
        F.expr("if(c_nationkey in (7, 8, 9), 300L, null)").alias("hasta"),
    )


def searches(spark: SparkSession, sf: str) -> DataFrame:
    """The total that every request of a session showed."""
    return log(spark, sf).select(F.col("session").alias("run_id"), "ts", "event_id", F.expr("cast(k div 20 as bigint)").alias("total"))


def views(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).select("session", "ts", "event_id", F.expr("case when request in ('view', 'click') then concat('t', k div 30) end").alias("token"))
