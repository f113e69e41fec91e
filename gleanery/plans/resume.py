"""Where a harvest goes on after an earlier run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.paging import page_count


class InvalidRange(ValueError):
    """A page range that cannot be read."""


def page_range(last: int, desde: int | None = None, hasta: int | None = None) -> tuple[int, int]:
    """First and last page to read; the end is drawn in to the last page, nothing else is mended."""
    start = 1 if desde is None else desde
    end = last if hasta is None else hasta
    if start < 1 or start > last:
        raise InvalidRange(f"first page {start} is not within 1..{last}")
    if end < start:
        raise InvalidRange(f"last page {end} comes before first page {start}")
    return start, min(end, last)


def in_page_range(records: DataFrame, last: int, desde: int | None = None, hasta: int | None = None) -> DataFrame:
    """Records of a page range, as a filter that reaches the scan."""
    start, end = page_range(last, desde, hasta)
    return records.where(F.col("pagina").between(start, end))


def resume_plan(requests: DataFrame, checkpoints: DataFrame, on: list[str]) -> DataFrame:
    """Plan per request: ``plan, desde, total_expected`` next to the request's columns.

    Requests have ``fuente, tarea, page_size, desde, hasta`` and the columns of ``on``,
    by which they find their checkpoint. The rules are tried in the order written here.
    """
    cp = checkpoints.select(*on, F.struct("fuente", "tarea", "pageSize", "total", "ultimaPagina", "completo").alias("cp"))
    joined = requests.join(cp, on, "left")
    asked, c = F.col("desde"), F.col("cp")
    fits = (
        (c["fuente"] == F.col("fuente"))
        & (c["tarea"] == F.col("tarea"))
        & (c["pageSize"] == F.col("page_size"))
        & (c["ultimaPagina"] >= 1)
    )
    following = c["ultimaPagina"] + 1
    last = page_count(c["total"], F.nullif(F.col("page_size"), F.lit(0)))
    open_end = F.col("hasta").isNull() & (F.col("page_size") > 0)
    plan = (
        F.when(asked.isNotNull(), "asked")
        .when(c.isNull(), "start")
        .when(~F.coalesce(fits, F.lit(False)), "ignored")
        .when(F.coalesce(c["completo"], F.lit(False)), "done")
        .when(F.col("hasta").isNotNull() & (following > F.col("hasta")), "covered")
        .when(open_end & (following > last), "done")
        .otherwise("resume")
    )
    return joined.withColumn("plan", plan).select(
        *requests.columns,
        "plan",
        F.when(F.col("plan") == "asked", asked).when(F.col("plan") == "resume", following).cast("bigint").alias("from_page"),
        F.when(F.col("plan") == "resume", c["total"]).alias("total_expected"),
    )


def must_restart(total: Column, expected: Column) -> Column:
    """A total other than the one expected has shifted every position: read from page 1."""
    return F.coalesce(total != expected, F.lit(False))
