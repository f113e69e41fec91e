"""Request logs: outcome classes, run metrics, streaks, degradation, attempts.

A log has ``ts, event_id`` (a total order), a session and the outcome of each request.
Running windows go through :mod:`gleanery.operators.ordered`, as a session may hold a
large part of the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import outcome as oc
from gleanery.operators import ordered
from gleanery.operators.rank_percentile import rank_percentiles

# Invalid downloads in a row that mean drift; the degradation window.
MAX_INVALID_STREAK = 3
WINDOW_SIZE, MIN_SAMPLES = 20, 5


def classify(log: DataFrame) -> DataFrame:
    """Add ``outcome``, ``retryable``, ``degrades``, ``max_attempts`` and ``base_ms``."""
    kind = oc.status_class(F.col("status"), F.col("net_code"))
    return log.withColumn("outcome", kind).withColumns(
        {
            "retryable": oc.is_retryable(F.col("outcome"), F.col("net_code")),
            "degrades": oc.degrades_server(F.col("outcome")),
            "max_attempts": oc.max_attempts(F.col("outcome")),
            "base_ms": oc.backoff_base_ms(F.col("outcome")),
        }
    )


def run_metrics(classified: DataFrame, keys: list[str], request: list[str]) -> DataFrame:
    """Requests, good ones, throttled, failed, retries and the throttling rate (0 without requests).

    All tries of a logical request but its first are retries, so nothing has to be put in order: tries are counted by request.
    """
    tries = classified.groupBy(*dict.fromkeys([*keys, *request])).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") == "throttled").alias("throttled"),
        F.count_if(~F.col("outcome").isin("ok", "throttled")).alias("failed"),
    )
    throttled, requests = F.sum("throttled"), F.sum("n")
    return tries.groupBy(*keys).agg(
        requests.alias("requests"), F.sum("ok").alias("ok"), throttled.alias("throttled"), F.sum("failed").alias("failed"), F.sum(F.col("n") - 1).alias("retries"),
        F.coalesce(F.try_divide(throttled, requests), F.lit(0.0)).alias("throttle_rate"),
    )


def latency(log: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Exact p50 and p95 per key, rounded half up."""
    stats = rank_percentiles(log, keys, "latency_ms", {"p50": 0.5, "p95": 0.95}, parts)
    return stats.withColumns({c: F.floor(F.col(c) + 0.5).cast("bigint") for c in ("p50", "p95")})


def named_counters(deltas: DataFrame, name: str, delta: str) -> DataFrame:
    """Sum of the deltas per counter."""
    return deltas.groupBy(F.col(name).alias("counter")).agg(F.sum(delta).alias("total"))


def counters_map(counters: DataFrame) -> DataFrame:
    """Counters as one map; there are as many entries as counter names."""
    return counters.agg(F.map_from_entries(F.collect_list(F.struct("counter", "total"))).alias("counters"))


def error_histogram(classified: DataFrame, problem: Column) -> DataFrame:
    code = oc.failure_code(problem, F.col("outcome"))
    failed = classified.select(code.alias("code")).where("code is not null")
    return failed.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def invalid_streak(downloads: DataFrame, session: str, result: str, parts: int | None = None) -> DataFrame:
    """Invalid downloads in a row; only a success resets the count, other failures leave it.

    The streak is the running count of invalid ones, less that count at the last success.
    """
    b = ordered.blocks(downloads, [session], ["ts", "event_id"], parts)
    b = ordered.running(b, {"_bad": ("sum", (F.col(result) == "invalid").cast("bigint"))})
    b = ordered.running(b, {"_at_ok": ("max", F.when(F.col(result) == "ok", F.col("_bad")))})
    streak = F.col("_bad") - F.coalesce(F.col("_at_ok"), F.lit(0))
    out = ordered.finish(b).withColumn("streak", streak).drop("_bad", "_at_ok")
    return out.withColumn("drift", (F.col(result) == "invalid") & (F.col("streak") >= MAX_INVALID_STREAK))


def download_findings(streaks: DataFrame, session: str) -> DataFrame:
    """``descarga-no-pdf`` for each session whose downloads were invalid too often in a row: where that was, and how many by then."""
    at = F.struct("ts", "event_id")
    return streaks.where("drift").groupBy(session).agg(F.min_by("streak", at).alias("n"), F.min_by("event_id", at).alias("event_id")).select(
        session, F.lit("descarga-no-pdf").alias("kind"), F.lit("error").alias("level"), "event_id", "n"
    )


def rolling_degradation(classified: DataFrame, session: str, parts: int | None = None, chunk_rows: int = ordered.CHUNK_ROWS) -> DataFrame:
    """Degraded outcomes among the last 20, and whether they are half of at least 5."""
    b = ordered.blocks(classified, [session], ["ts", "event_id"], parts)
    sums = {"window_n": F.lit(1).cast("bigint"), "window_degraded": F.col("degrades").cast("bigint")}
    out = ordered.rolling_sum(b, WINDOW_SIZE, sums, chunk_rows)
    half = F.col("window_degraded") * 2 >= F.col("window_n")
    return out.withColumn("would_open", F.col("degrades") & (F.col("window_n") >= MIN_SAMPLES) & half)


def attempts(log: DataFrame, request: list[str], previous: str | None = None, parts: int | None = None) -> DataFrame:
    """Number the tries of each logical request, and add those of earlier runs."""
    b = ordered.rank(ordered.blocks(log, request, ["ts", "event_id"], parts), "attempt")
    before = F.coalesce(F.col(previous), F.lit(0)) if previous else F.lit(0)
    return ordered.finish(b).withColumn("attempts_total", F.col("attempt") + before)


def retry_budget(classified: DataFrame) -> DataFrame:
    """Would a failed try be tried again, and with what upper bound on the delay."""
    again = F.col("retryable") & (F.col("attempt") < F.col("max_attempts"))
    bound = oc.backoff_bound_ms(F.col("outcome"), F.col("attempt"))
    return classified.withColumn("would_retry", again).withColumn("delay_bound_ms", F.when(again, bound))


def changed_since_last(rows: DataFrame, keys: list[str], order: list[str], value: str, parts: int | None = None) -> DataFrame:
    """Add ``previous`` (last known value before the row) and ``changed``; absent values do not count."""
    b = ordered.blocks(rows, keys, order, parts)
    b = ordered.running(b, {"previous": ("last", F.col(value))}, inclusive=False)
    changed = F.col(value).isNotNull() & F.col("previous").isNotNull() & (F.col(value) != F.col("previous"))
    return ordered.finish(b).withColumn("changed", changed)


def total_change(searches: DataFrame, run: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Searches of a run whose declared total differs from the search before."""
    return changed_since_last(searches, [run], order, "total", parts).where("changed").drop("changed")


def token_rotation(views: DataFrame, session: str, parts: int | None = None) -> DataFrame:
    """Views whose token differs from the last known one."""
    return changed_since_last(views, [session], ["ts", "event_id"], "token", parts)
