"""Classes of a request's outcome and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Socket codes of a host that cannot be reached, and of a passing failure.
UNREACHABLE_CODES = ("ECONNREFUSED", "EHOSTUNREACH", "ENETUNREACH", "ENOTFOUND")
TRANSIENT_CODES = ("ECONNRESET", "ECONNABORTED", "ETIMEDOUT", "EPIPE", "EAI_AGAIN", "ERR_NETWORK")

# Fixed values per class: (retryable, degrades the server, attempts allowed, backoff base in ms).
# A network failure is retryable only for the codes above.
CLASSES = {
    "ok": (False, False, 1, 0),
    "throttled": (True, True, 5, 1000),
    "access-denied": (False, True, 1, 0),
    "server-unavailable": (True, True, 4, 2000),
    "unexpected-status": (False, False, 1, 0),
    "network": (True, True, 3, 250),
    "host-unreachable": (True, True, 1, 0),
    "circuit-open": (True, False, 4, 1000),
}
BACKOFF_CAP_MS = 60_000

# What a downloaded document must look like.
PDF_MAGIC, MIN_FILE_BYTES = b"%PDF-", 1024


def status_class(status: Column, net_code: Column) -> Column:
    """Class of an outcome. Without a status the request failed on the socket."""
    return (
        F.when(status.between(200, 299), "ok")
        .when(status == 429, "throttled")
        .when(status == 403, "access-denied")
        .when(status >= 500, "server-unavailable")
        .when(status.isNotNull(), "unexpected-status")
        .when(net_code.isin(*UNREACHABLE_CODES), "host-unreachable")
        .otherwise("network")
    )


def _by_class(outcome: Column, field: int) -> Column:
    entries = [F.lit(x) for name, facts in CLASSES.items() for x in (name, facts[field])]
    return F.try_element_at(F.create_map(*entries), outcome)


def is_retryable(outcome: Column, net_code: Column) -> Column:
    transient = F.coalesce(net_code.isin(*TRANSIENT_CODES), F.lit(False))
    return F.when(outcome == "network", transient).otherwise(_by_class(outcome, 0))


def degrades_server(outcome: Column) -> Column:
    return _by_class(outcome, 1)


def max_attempts(outcome: Column) -> Column:
    return _by_class(outcome, 2)


def backoff_base_ms(outcome: Column) -> Column:
    return _by_class(outcome, 3)


def backoff_bound_ms(outcome: Column, attempt: Column) -> Column:
    """Upper end of the full-jitter delay before the try after ``attempt`` (1-based)."""
    doubled = backoff_base_ms(outcome) * F.pow(F.lit(2.0), attempt - 1)
    return F.least(F.lit(float(BACKOFF_CAP_MS)), doubled).cast("bigint")


# The three standard forms of a date in a header, and the places of day, month, year and time in them.
HTTP_DATES = [
    (r"^(?:[A-Za-z]+,\s*)?(\d{1,2})\s+([A-Z][a-z]{2})\s+(\d{4})\s+(\d{2}:\d{2}:\d{2})(?:\s*GMT)?$", (1, 2, 3, 4)),
    (r"^[A-Za-z]+,\s*(\d{1,2})-([A-Z][a-z]{2})-(\d{2})\s+(\d{2}:\d{2}:\d{2})\s*GMT$", (1, 2, 3, 4)),
    (r"^[A-Z][a-z]{2}\s+([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+(\d{4})$", (2, 1, 4, 3)),
]


def _date(value: Column, pattern: str, order: tuple[int, ...]) -> Column:
    """"day month year time" of a date in one form; two digits of a year below 50 are of this century."""
    day, month, year, time = (F.regexp_extract(value, pattern, i) for i in order)
    century = F.when(F.length(year) == 2, F.when(year < "50", "20").otherwise("19")).otherwise("")
    return F.when(value.rlike(pattern), F.concat_ws(" ", day, month, F.concat(century, year), time))


def retry_after_ms(header: Column, now: Column) -> Column:
    """Delay asked for by a Retry-After header, in ms; NULL (not 0) where it says nothing.

    ``now`` is a UTC timestamp without time zone: the clock is an input, so reruns agree.
    """
    value = F.trim(header)
    seconds = F.try_multiply(value.try_cast("bigint"), F.lit(1000).cast("bigint"))
    digits = F.when(value.rlike(r"^\d+$"), F.coalesce(seconds, F.lit((1 << 63) - 1)))  # more than a bigint holds: the longest wait
    moment = F.try_to_timestamp(F.coalesce(*[_date(value, p, order) for p, order in HTTP_DATES]), F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz")
    wait = F.timestamp_diff("MILLISECOND", now.cast("timestamp_ntz"), moment)
    # greatest() skips NULLs, and no moment must stay no delay.
    return F.coalesce(digits, F.when(wait < 0, F.lit(0).cast("bigint")).otherwise(wait))


def file_problem(content: Column, length: Column, min_bytes: int = MIN_FILE_BYTES) -> Column:
    """``magic``, ``tamano`` or NULL; the first bytes are looked at before the size."""
    head = F.substring(content, 1, len(PDF_MAGIC))
    return F.when(head != F.lit(PDF_MAGIC), "magic").when(length < min_bytes, "tamano")


def failure_code(problem: Column, outcome: Column) -> Column:
    """Code under which a failed download is queued; NULL where it is no queue case."""
    return F.when(problem.isNotNull(), F.concat(F.lit("documento-"), problem)).when(
        outcome != "ok", outcome
    )
