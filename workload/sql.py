"""The tables of ``workload/tables.py`` as DuckDB common table expressions."""

WS = "[\\s\\x{0b}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+"


def ws(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}', ' ', 'g'))"


def slug(expr: str) -> str:
    dashed = f"regexp_replace(regexp_replace(lower(strip_accents({expr})), '[^a-z0-9]+', '-', 'g'), '^-+', '')"
    return f"regexp_replace(substr({dashed}, 1, 80), '-+$', '')"


def year(expr: str) -> str:
    return (
        f"list_filter(list_transform(list_filter(regexp_extract_all({expr}, '-\\s*(\\d+)', 1), lambda s: length(s) = 4),"
        " lambda s: CAST(s AS INT)), lambda y: y BETWEEN 1900 AND 2100)[1]"
    )


def sha24(expr: str) -> str:
    return f"substr(sha1({expr}), 1, 24)"


def thousands(expr: str) -> str:
    return f"replace(format('{{:,}}', CAST({expr} AS BIGINT)), ',', '.')"


DOCS = f"""docs AS (
  SELECT *, CASE WHEN labelled THEN {sha24('text')} END AS documentoUuid,
    source AS fuente, doc_id AS indice, CAST(doc_id // 10 + 1 + coalesce(toxic, 0) AS BIGINT) AS pagina,
    TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS capturadoEn
  FROM (SELECT d.*, l.doc_id IS NOT NULL AS labelled, l.toxic, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))"""

_PARTIES = "list_filter(list_transform(string_split(text, chr(10)), lambda x: " + ws("x") + "), lambda x: x <> '')"

RECORDS = DOCS + f""", recs0 AS (
  SELECT *, lang || '-' || n_chars AS expediente, {_PARTIES} AS administrados, lang AS unidadFiscalizable,
    CASE WHEN n_chars % 97 = 0 THEN ' ' ELSE 'S' || (n_chars % 20) END AS sector,
    n_chars || '-' || (n_chars % 250 + 1890) || '-' || upper(lang) AS resolucion
  FROM docs), records AS (
  SELECT *, {year('resolucion')} AS anioResolucion,
    {sha24("concat_ws(chr(0), expediente, array_to_string(administrados, '|'), unidadFiscalizable, sector, resolucion, coalesce(documentoUuid, ''))")} AS id,
    documentoUuid || '_' || {slug('resolucion')} || '.pdf' AS archivo
  FROM recs0)"""

MANIFEST = RECORDS + f""", manifest AS (
  SELECT CASE WHEN toxic = 1 THEN {sha24("'lost:' || id")} ELSE id END AS id, fuente,
    CASE WHEN quality = 0 THEN reverse(documentoUuid) ELSE documentoUuid END AS documentoUuid,
    pagina, indice, archivo, n_chars AS bytes, sha256(text) AS sha256, indice AS seq
  FROM records WHERE labelled), probe AS (
  SELECT archivo, CAST(max(octet_length(encode(text))) AS BIGINT) AS bytes, max(sha256(CASE WHEN source = 'src3' THEN text || '!' ELSE text END)) AS sha256
  FROM records WHERE labelled AND lang <> 'de' GROUP BY archivo)"""

LOG = """log0 AS (SELECT *, CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS INT) AS k FROM events), log AS (
  SELECT event_id, ts, user_id AS session, event_type AS request,
    CASE WHEN k < 5 THEN 429 WHEN k < 8 THEN 403 WHEN k < 15 THEN 503 WHEN k < 20 THEN 404 WHEN k < 97 THEN 200 END AS status,
    CASE k WHEN 97 THEN 'ECONNRESET' WHEN 98 THEN 'ECONNREFUSED' END AS net_code,
    CASE WHEN k = 0 THEN 'Mon, ' || strftime(ts + INTERVAL 90 SECOND, '%d %b %Y %H:%M:%S') || ' GMT' WHEN k = 1 THEN 'soon' WHEN k < 5 THEN CAST(k AS VARCHAR) END AS retry_after,
    value AS latency_ms, k FROM log0), classes AS (
  SELECT * FROM (VALUES ('ok', false, false, 1, 0), ('throttled', true, true, 5, 1000), ('access-denied', false, true, 1, 0),
    ('server-unavailable', true, true, 4, 2000), ('unexpected-status', false, false, 1, 0), ('network', true, true, 3, 250),
    ('host-unreachable', true, true, 1, 0)) c(outcome, retry, degrades, max_attempts, base_ms)), classified AS (
  SELECT l.*, c.degrades, c.max_attempts, c.base_ms,
    CASE WHEN c.outcome = 'network' THEN coalesce(l.net_code = 'ECONNRESET', false) ELSE c.retry END AS retryable
  FROM (SELECT *, row_number() OVER (PARTITION BY session, request ORDER BY ts, event_id) AS attempt,
      CASE WHEN status = 200 THEN 'ok' WHEN status = 429 THEN 'throttled' WHEN status = 403 THEN 'access-denied' WHEN status >= 500 THEN 'server-unavailable'
        WHEN status IS NOT NULL THEN 'unexpected-status' WHEN net_code = 'ECONNREFUSED' THEN 'host-unreachable' ELSE 'network' END AS kind FROM log) l
  JOIN (SELECT outcome, outcome AS kind, retry, degrades, max_attempts, base_ms FROM classes) c ON l.kind = c.kind)"""

QUEUE = LOG + """, queue AS (
  SELECT event_id AS seq, 'u' || session AS id, CASE WHEN latency_ms < 1 THEN 'page' ELSE 'pdf' END AS tipo,
    CASE WHEN kind = 'ok' THEN 'documento-magic' ELSE kind END AS error, CAST(k // 15 AS INT) AS intentos, ts AS ultimoTs,
    CASE WHEN k < 95 THEN k END AS pagina
  FROM classified WHERE request = 'error'), latest AS (
  SELECT * FROM queue QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)"""

PAGE_ROWS = f"""page_rows AS (
  SELECT o_orderkey // 5000 AS run_id, (o_orderkey % 5000) // 10 + 1 AS numero, o_orderkey % 10 AS pos,
    o_orderkey % 5000 + CASE WHEN o_totalprice > 497000 THEN 1 ELSE 0 END AS indice,
    o_orderkey % 5000 + 1 + CASE WHEN o_totalprice BETWEEN 3000 AND 4000 THEN 1 ELSE 0 END AS nro,
    CASE WHEN o_totalprice < 2000 THEN 6 ELSE 7 END AS columnas,
    CASE WHEN o_totalprice BETWEEN 2000 AND 3000 THEN 'ilegible' WHEN o_orderstatus = 'P' THEN 'sin-enlace' ELSE 'ok' END AS estado,
    {sha24("o_custkey || '/' || o_orderpriority")} AS id, o_totalprice NOT BETWEEN 4000 AND 4500 AS valid,
    o_custkey % 50 = 0 AS sin_administrado, o_custkey % 51 = 0 AS sin_expediente, o_custkey % 97 = 0 AS sin_celdas
  FROM orders), seen AS (
  SELECT *, min(numero) OVER (PARTITION BY run_id, id) AS first_page, count(*) OVER (PARTITION BY run_id, numero, id) AS copies FROM page_rows), repeated AS (
  SELECT run_id, numero, count(*) AS n_rows, count(*) - count(DISTINCT id) AS n_identical, count(*) FILTER (first_page < numero) AS n_seen
  FROM seen GROUP BY run_id, numero)"""

LANDED = PAGE_ROWS + """, landed AS (
  SELECT *, (numero - 1) * 10 AS first, CASE run_id % 3 WHEN 0 THEN 5000 WHEN 2 THEN 4995 END AS total, CASE WHEN top > 498000 THEN 20 ELSE 10 END AS widget_page_size,
    CASE WHEN run_id > 0 THEN 4999 + run_id % 2 END AS previous_total, CASE WHEN low < 2500 THEN 4999 ELSE 5000 END AS label_total
  FROM (SELECT o_orderkey // 5000 AS run_id, (o_orderkey % 5000) // 10 + 1 AS numero, max(o_totalprice) AS top, min(o_totalprice) AS low FROM orders GROUP BY ALL))"""
