"""Request logs, windows over them, and the failure queue."""

from pyspark.sql import functions as F

from gleanery.operators.rank_percentile import rank_percentiles
from gleanery.plans import requestlog, resume, retry
from workload import sql as S
from workload import tables as T
from workload.registry import query


@query(
    "run_metrics",
    f"""WITH {S.LOG} SELECT session, count(*) AS requests, count(*) FILTER (kind = 'ok') AS ok, count(*) FILTER (kind = 'throttled') AS throttled,
      count(*) FILTER (kind NOT IN ('ok', 'throttled')) AS failed, count(*) FILTER (attempt > 1) AS retries,
      count(*) FILTER (kind = 'throttled') / count(*) AS throttle_rate FROM classified GROUP BY session""",
)
def _(spark, sf):
    return requestlog.run_metrics(requestlog.classify(T.log(spark, sf)), ["session"], ["session", "request"])


@query(
    "download_drift",
    f"""WITH {S.LOG}, d AS (SELECT session, ts, event_id, CASE WHEN k >= 40 THEN 'ok' WHEN k < 25 THEN 'invalid' ELSE 'failed' END AS result FROM log),
      g AS (SELECT *, sum(CASE WHEN result = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY ts, event_id) AS grp FROM d),
      s AS (SELECT *, sum(CASE WHEN result = 'invalid' THEN 1 ELSE 0 END) OVER (PARTITION BY session, grp ORDER BY ts, event_id) AS streak FROM g)
      SELECT session, 'descarga-no-pdf' AS kind, 'error' AS level, event_id, CAST(streak AS BIGINT) AS n FROM s WHERE result = 'invalid' AND streak >= 3 QUALIFY row_number() OVER (PARTITION BY session ORDER BY ts, event_id) = 1""",
)
def _(spark, sf):
    return requestlog.download_findings(requestlog.invalid_streak(T.downloads(spark, sf), "session", "result"), "session")


def _percentile_sql(keys: str, p: float) -> str:
    over = f"PARTITION BY {keys}" if keys else ""
    return (
        f"CAST(floor(max(CASE WHEN rn = least(n, CAST(floor({p} * n) AS BIGINT) + 1) THEN latency_ms END) + 0.5) AS BIGINT)",
        f"(SELECT *, row_number() OVER ({over} ORDER BY latency_ms) AS rn, count(*) OVER ({over}) AS n FROM log)",
    )


_P50, _BY = _percentile_sql("session", 0.5)
_P95, _ = _percentile_sql("session", 0.95)
_ALL = _percentile_sql("", 0.5)[1]


@query("latency_percentile", f"WITH {S.LOG} SELECT session, count(*) AS n, {_P50} AS p50, {_P95} AS p95 FROM {_BY} GROUP BY session")
def _(spark, sf):
    return requestlog.latency(T.log(spark, sf), ["session"])


@query("latency_percentile_all", f"WITH {S.LOG} SELECT count(*) AS n, {_P50} AS p50, {_P95} AS p95 FROM {_ALL}")
def _(spark, sf):
    return requestlog.latency(T.log(spark, sf), [])


@query(
    "rank_percentile",
    """SELECT event_type, count(*) AS n, max(CASE WHEN rn = least(n, CAST(floor(0.9 * n) AS BIGINT) + 1) THEN value END) AS p90
      FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events) GROUP BY 1""",
)
def _(spark, sf):
    return rank_percentiles(T.table(spark, sf, "events"), ["event_type"], "value", {"p90": 0.9})


_DELTAS = f"WITH {S.LOG}, deltas AS (SELECT 'requests' AS counter, 1 AS d FROM log UNION ALL SELECT 'latency.' || request, k FROM log)"


def _deltas(spark, sf):
    log = T.log(spark, sf)
    one = F.struct(F.lit("requests").alias("name"), F.lit(1).alias("d"))
    more = F.struct(F.concat(F.lit("latency."), "request").alias("name"), F.col("k").alias("d"))
    return log.select(F.explode(F.array(one, more)).alias("x")).select("x.*")


@query("named_counters", f"{_DELTAS} SELECT counter, CAST(sum(d) AS BIGINT) AS total FROM deltas GROUP BY 1")
def _(spark, sf):
    return requestlog.named_counters(_deltas(spark, sf), "name", "d")


@query(
    "counters_map",
    f"""{_DELTAS}, c AS (SELECT counter, sum(d) AS total FROM deltas GROUP BY 1)
      SELECT string_agg(counter || '=' || CAST(total AS BIGINT), ',' ORDER BY counter) AS counters FROM c""",
)
def _(spark, sf):
    m = requestlog.counters_map(requestlog.named_counters(_deltas(spark, sf), "name", "d"))
    pairs = F.transform(F.array_sort(F.map_entries("counters")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select(F.array_join(pairs, ",").alias("counters"))


@query("error_histogram", f"WITH {S.LOG} SELECT CASE WHEN kind = 'ok' THEN 'documento-magic' ELSE kind END AS code, count(*) AS n FROM classified WHERE kind <> 'ok' OR latency_ms < 5 GROUP BY 1")
def _(spark, sf):
    c = requestlog.classify(T.log(spark, sf))
    return requestlog.error_histogram(c, F.expr("case when outcome = 'ok' and latency_ms < 5 then 'magic' end"))


@query(
    "invalid_streak",
    f"""WITH {S.LOG}, d AS (SELECT session, ts, event_id, CASE WHEN k >= 40 THEN 'ok' WHEN k < 25 THEN 'invalid' ELSE 'failed' END AS result FROM log),
      g AS (SELECT *, sum(CASE WHEN result = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY ts, event_id) AS grp FROM d)
      SELECT event_id, session, result, CAST(streak AS BIGINT) AS streak, result = 'invalid' AND streak >= 3 AS drift FROM (
        SELECT *, sum(CASE WHEN result = 'invalid' THEN 1 ELSE 0 END) OVER (PARTITION BY session, grp ORDER BY ts, event_id) AS streak FROM g)""",
)
def _(spark, sf):
    return requestlog.invalid_streak(T.downloads(spark, sf), "session", "result").drop("ts")


@query(
    "rolling_degradation",
    f"""WITH {S.LOG} SELECT event_id, n AS window_n, CAST(bad AS BIGINT) AS window_degraded, degrades AND n >= 5 AND bad * 2 >= n AS would_open FROM (
      SELECT event_id, degrades, count(*) OVER w AS n, sum(CASE WHEN degrades THEN 1 ELSE 0 END) OVER w AS bad FROM classified
      WINDOW w AS (PARTITION BY session ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""",
)
def _(spark, sf):
    c = requestlog.classify(T.log(spark, sf))
    return requestlog.rolling_degradation(c, "session").select("event_id", "window_n", "window_degraded", "would_open")


@query("attempt_number", f"WITH {S.LOG} SELECT event_id, attempt, attempt + k AS attempts_total FROM classified")
def _(spark, sf):
    return requestlog.attempts(T.log(spark, sf), ["session", "request"], "k").select("event_id", "attempt", "attempts_total")


@query(
    "retry_budget",
    f"""WITH {S.LOG} SELECT event_id, kind AS outcome, attempt, max_attempts, retryable AND attempt < max_attempts AS would_retry,
      CASE WHEN retryable AND attempt < max_attempts THEN CAST(least(60000, base_ms * pow(2, attempt - 1)) AS BIGINT) END AS delay_bound_ms FROM classified""",
)
def _(spark, sf):
    return requestlog.retry_budget(T.classified(spark, sf)).select("event_id", "outcome", "attempt", "max_attempts", "would_retry", "delay_bound_ms")


@query(
    "total_change",
    f"""WITH {S.LOG}, s AS (SELECT session AS run_id, event_id, k // 20 AS total, lag(k // 20) OVER (PARTITION BY session ORDER BY ts, event_id) AS previous FROM log)
      SELECT run_id, event_id, CAST(total AS BIGINT) AS total, CAST(previous AS BIGINT) AS previous FROM s WHERE total <> previous""",
)
def _(spark, sf):
    return requestlog.total_change(T.searches(spark, sf), "run_id", ["ts", "event_id"]).select("run_id", "event_id", "total", "previous")


@query(
    "token_rotation",
    f"""WITH {S.LOG}, v AS (SELECT session, ts, event_id, CASE WHEN request IN ('view', 'click') THEN 't' || k // 30 END AS token FROM log),
      p AS (SELECT *, last_value(token IGNORE NULLS) OVER (PARTITION BY session ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM v)
      SELECT event_id, session, token, previous, coalesce(token <> previous, false) AS changed FROM p""",
)
def _(spark, sf):
    return requestlog.token_rotation(T.views(spark, sf), "session").drop("ts")


_ENTRY = ["seq", "id", "tipo", "error", "intentos"]


@query("dlq_latest", f"WITH {S.QUEUE} SELECT {', '.join(_ENTRY)} FROM latest")
def _(spark, sf):
    return retry.collapse(T.queue(spark, sf)).select(*_ENTRY)


_PENDING = "pending AS (SELECT * FROM latest WHERE tipo = 'pdf' AND intentos < 5)"


@query(
    "retry_page_span",
    f"""WITH {S.QUEUE}, {_PENDING} SELECT count(*) AS pending, CASE WHEN bool_and(coalesce(pagina >= 1, false)) THEN CAST(min(pagina) AS BIGINT) END AS desde,
      CASE WHEN bool_and(coalesce(pagina >= 1, false)) THEN CAST(max(pagina) AS BIGINT) END AS hasta FROM pending""",
)
def _(spark, sf):
    return retry.page_span(retry.retryable_entries(retry.collapse(T.queue(spark, sf))))


def _reconcile(spark, sf, complete):
    q = T.queue(spark, sf)
    old, new = q.where("hour(ultimoTs) < 12"), q.where("hour(ultimoTs) >= 12")
    resolved = q.where("error = 'documento-magic' and intentos = 2").select("id")
    return retry.reconcile(retry.collapse(old), new, resolved, complete, F.expr("timestamp_ntz'2030-01-01 00:00:00'"))


def _reconcile_sql(complete):
    rest = "error, intentos" if not complete else "'no-encontrado' AS error, intentos + 1 AS intentos"
    when = "ultimoTs" if not complete else "TIMESTAMP '2030-01-01' AS ultimoTs"
    last = "QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1"
    return f"""WITH {S.QUEUE}, old AS (SELECT * FROM queue WHERE hour(ultimoTs) < 12 {last}), new AS (SELECT * FROM queue WHERE hour(ultimoTs) >= 12 {last}),
      resolved AS (SELECT id FROM queue WHERE error = 'documento-magic' AND intentos = 2), pending AS (SELECT * FROM old WHERE tipo = 'pdf' AND intentos < 5)
      SELECT id, error, intentos, ultimoTs FROM new WHERE id IN (SELECT id FROM pending)
      UNION ALL SELECT id, {rest}, {when} FROM pending WHERE id NOT IN (SELECT id FROM new) AND id NOT IN (SELECT id FROM resolved)
      UNION ALL SELECT id, error, intentos, ultimoTs FROM old WHERE tipo = 'pdf' AND intentos >= 5"""


@query("dlq_reconcile", _reconcile_sql(True))
def _(spark, sf):
    return _reconcile(spark, sf, True).select("id", "error", "intentos", "ultimoTs")


@query("dlq_reconcile_cut_short", _reconcile_sql(False))
def _(spark, sf):
    return _reconcile(spark, sf, False).select("id", "error", "intentos", "ultimoTs")


@query(
    "queue_union",
    f"WITH {S.QUEUE} SELECT id, intentos, 'pending' AS part FROM latest WHERE tipo = 'pdf' AND intentos < 5 UNION ALL SELECT id, intentos, 'exhausted' FROM latest WHERE tipo = 'pdf' AND intentos >= 5",
)
def _(spark, sf):
    q = retry.collapse(T.queue(spark, sf))
    pending = retry.retryable_entries(q).select("id", "intentos", F.lit("pending").alias("part"))
    return pending.unionByName(retry.exhausted_entries(q).select("id", "intentos", F.lit("exhausted").alias("part")))


_CP = """cp AS (SELECT c_custkey, c_mktsegment AS fuente, CASE WHEN c_nationkey < 3 THEN 'download' ELSE 'scrape' END AS tarea,
  CASE WHEN c_nationkey = 4 THEN 20 ELSE 10 END AS pageSize, CAST(trunc(abs(c_acctbal)) AS BIGINT) AS total, c_custkey % 700 AS ultimaPagina,
  c_nationkey > 20 AS completo FROM customer WHERE c_acctbal > 0),
req AS (SELECT c_custkey, c_mktsegment AS fuente, CASE WHEN c_nationkey = 5 THEN 0 ELSE 10 END AS page_size,
  CASE WHEN c_nationkey = 6 THEN 3 END AS desde, CASE WHEN c_nationkey IN (7, 8, 9) THEN 300 END AS hasta FROM customer),
plans AS (SELECT r.*, cp.total AS cp_total, cp.ultimaPagina + 1 AS next, CASE WHEN r.desde IS NOT NULL THEN 'asked' WHEN cp.c_custkey IS NULL THEN 'start'
  WHEN cp.tarea <> 'scrape' OR cp.pageSize <> r.page_size OR cp.ultimaPagina < 1 THEN 'ignored' WHEN cp.completo THEN 'done'
  WHEN r.hasta IS NOT NULL AND cp.ultimaPagina + 1 > r.hasta THEN 'covered'
  WHEN r.hasta IS NULL AND r.page_size > 0 AND cp.ultimaPagina + 1 > greatest(1, ceil(cp.total / 10)) THEN 'done' ELSE 'resume' END AS plan
  FROM req r LEFT JOIN cp ON r.c_custkey = cp.c_custkey)"""


def _plans(spark, sf):
    cp = T.checkpoints(spark, sf).join(T.table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey"), "c_custkey", "left_semi")
    return resume.resume_plan(T.resume_requests(spark, sf), cp, ["c_custkey"])


@query(
    "resume_plan",
    f"""WITH {_CP} SELECT c_custkey, plan, CAST(CASE plan WHEN 'asked' THEN desde WHEN 'resume' THEN next END AS BIGINT) AS from_page,
      CASE WHEN plan = 'resume' THEN cp_total END AS total_expected FROM plans""",
)
def _(spark, sf):
    return _plans(spark, sf).select("c_custkey", "plan", "from_page", "total_expected")


@query("restart_on_total_change", f"WITH {_CP} SELECT c_custkey, CASE WHEN plan = 'resume' AND cp_total > 5000 THEN 1 WHEN plan = 'resume' THEN next END AS start_page FROM plans WHERE plan = 'resume'")
def _(spark, sf):
    p = _plans(spark, sf).where("plan = 'resume'")
    now = F.least(F.col("total_expected"), F.lit(5000).cast("bigint"))
    start = F.when(resume.must_restart(now, F.col("total_expected")), 1).otherwise(F.col("from_page"))
    return p.select("c_custkey", start.alias("start_page"))
