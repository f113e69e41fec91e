"""The failure queue: collapse, plan a retry, reconcile after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.keep import latest

MAX_TRIES = 5  # default of the retry job: entries with as many tries are exhausted
NOT_FOUND = "no-encontrado"  # fixed value: code of a record that its page no longer has

FIELDS = ["id", "tipo", "error", "intentos", "ultimoTs", "detalle", "contexto"]


def collapse(queue: DataFrame) -> DataFrame:
    """Latest entry per id, in file order."""
    return latest(queue, "id")


def retryable_entries(queue: DataFrame, max_tries: int = MAX_TRIES) -> DataFrame:
    return queue.where((F.col("tipo") == "pdf") & (F.col("intentos") < max_tries))


def exhausted_entries(queue: DataFrame, max_tries: int = MAX_TRIES) -> DataFrame:
    return queue.where((F.col("tipo") == "pdf") & (F.col("intentos") >= max_tries))


def page_span(pending: DataFrame) -> DataFrame:
    """First and last page of the pending entries; both NULL as soon as one names no valid page."""
    page = F.try_element_at("contexto", F.lit("pagina")).try_cast("bigint")
    known = F.coalesce(F.bool_and(F.coalesce(page >= 1, F.lit(False))), F.lit(False))
    return pending.agg(
        F.count(F.lit(1)).alias("pending"),
        F.when(known, F.min(page)).alias("desde"),
        F.when(known, F.max(page)).alias("hasta"),
    )


def reconcile(
    queue: DataFrame,
    new_failures: DataFrame,
    resolved: DataFrame,
    complete: bool,
    now: Column,
    max_tries: int = MAX_TRIES,
) -> DataFrame:
    """The queue after a retry run over a collapsed ``queue``.

    A new failure replaces its entry and a resolved entry goes. What the run did not come
    across stays as it is if the run was cut short; otherwise its record has moved, and it
    counts as one more try. Exhausted entries stay.
    """
    pending = retryable_entries(queue, max_tries).select(*FIELDS)
    # All three sides hold one row per id, so no key can be hot.
    failed = collapse(new_failures).select(*FIELDS)
    again = failed.join(pending.select("id"), "id", "left_semi")
    rest = pending.join(failed.select("id"), "id", "left_anti")
    rest = rest.join(resolved.select("id").distinct(), "id", "left_anti")
    if complete:
        rest = rest.withColumns(
            {
                "error": F.lit(NOT_FOUND),
                "intentos": (F.col("intentos") + 1).cast(queue.schema["intentos"].dataType),
                "ultimoTs": now,
                "detalle": F.lit("its page was read and the row was not on it"),
            }
        )
    return again.unionByName(rest).unionByName(exhausted_entries(queue, max_tries).select(*FIELDS))
