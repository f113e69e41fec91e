"""Structural drift, page by page.

A harvester stops at the first sign; a table shows all of them. ``precedence`` tells which
one would have been first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.paging import expected_rows
from gleanery.operators.skew import lookup
from gleanery.sources.sinks import settle

PAGE = ["run_id", "numero"]
FLAGS = ("sin_administrado", "sin_expediente", "sin_celdas")  # fixed values: fields counted where a row lacks them


def repeated_in_run(rows: DataFrame) -> DataFrame:
    """Per page: rows, rows equal to another of the page, rows seen on an earlier page of the run.

    Copies within a page are counted before anything is joined, so what is looked up is one
    row per page and id.
    """
    per = rows.groupBy(*PAGE, "id").agg(F.count(F.lit(1)).alias("c"))
    first = per.groupBy("run_id", "id").agg(F.min("numero").alias("_first"))
    seen = lookup(per, first, ["run_id", "id"])
    return seen.groupBy(*PAGE).agg(
        F.sum("c").alias("n_rows"),
        F.sum(F.col("c") - 1).alias("n_identical"),
        F.coalesce(F.sum(F.when(F.col("_first") < F.col("numero"), F.col("c"))), F.lit(0)).alias("n_seen"),
    )


def page_overlap(rows: DataFrame) -> DataFrame:
    """Pages with rows seen on an earlier page of the run: all → error, some → warning."""
    found = repeated_in_run(rows).where("n_seen > 0")
    level = F.when(F.col("n_seen") == F.col("n_rows"), "error").otherwise("aviso")
    return found.select(*PAGE, "n_rows", "n_seen", level.alias("level"))


def misaligned_index(rows: DataFrame, base: Column) -> DataFrame:
    """First row of each page whose index is not ``base`` plus its place."""
    off = rows.where(F.col("indice") != base + F.col("pos"))
    return off.groupBy(*PAGE).agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n"))


def misnumbered(rows: DataFrame) -> DataFrame:
    """Rows whose printed number is not their index plus one; an unreadable number counts."""
    return rows.where(~F.col("nro").eqNullSafe(F.col("indice") + 1))


def page_findings(
    pages: DataFrame,
    rows: DataFrame,
    columns: int = 7,
    numbered_per_page: bool = False,
) -> DataFrame:
    """``run_id, numero, kind, level, precedence, n, first_pos`` of every sign on every page.

    ``pages``: ``run_id, numero, first, total, page_size, widget_page_size, is_search,
    previous_total, label_total, has_component, marked_empty, headers, expected_headers``.
    ``rows``: ``run_id, numero, pos, indice, nro, columnas, estado, id, valid``, and where a source has them the flags
    ``sin_administrado, sin_expediente, sin_celdas`` of fields that a row lacks.

    ``numbered_per_page`` is the naming-container mode: rows are numbered from 0 on each page, and ``has_component`` tells
    whether any id has the form of a row's.

    Rows are read once: what they tell is summed by page, id and offset (index less place), written, and looked up from there.
    """
    bad = {
        "columnas": F.col("columnas") != columns,
        "numeracion": ~F.col("nro").eqNullSafe(F.col("indice") + 1) if not numbered_per_page else F.lit(False),
        "sin-uuid": F.col("estado") == "ilegible",
        "registro-invalido": ~F.col("valid"),
        "sin_documento": F.col("estado") == "sin-enlace",
        **{flag: F.col(flag) for flag in FLAGS if flag in rows.columns},
    }
    per = rows.withColumn("_off", F.col("indice") - F.col("pos")).groupBy(*PAGE, "id", "_off").agg(
        F.count(F.lit(1)).alias("c"),
        F.min("pos").alias("_pos"),
        *[F.count_if(c).alias(f"n:{k}") for k, c in bad.items()],
        *[F.min(F.when(c, F.col("pos"))).alias(f"p:{k}") for k, c in bad.items()],
    )
    per = settle(per, "drift")
    first = per.groupBy("run_id", "id").agg(F.min("numero").alias("_first"))
    rest = [c for c in pages.columns if c not in PAGE]
    found = pages.select(*PAGE, F.struct(*rest).alias("page")).join(lookup(per, first, ["run_id", "id"]), PAGE, "left")
    base = F.lit(0) if numbered_per_page else (F.col("numero") - 1) * F.col("page.page_size")
    off = F.col("_off") != base
    p = found.groupBy(*PAGE).agg(
        F.first("page").alias("page"),
        F.sum("c").alias("n_rows"),
        (F.sum("c") - F.count_distinct("id") - F.max(F.when(F.col("c").isNotNull() & F.col("id").isNull(), 1).otherwise(0))).alias("n_identical"),
        F.sum(F.when(F.col("_first") < F.col("numero"), F.col("c")).otherwise(0)).alias("n_seen"),
        F.sum(F.when(off, F.col("c"))).alias("n:indices-desalineados"),
        F.min(F.when(off, F.col("_pos"))).alias("p:indices-desalineados"),
        *[F.sum(f"`n:{k}`").alias(f"n:{k}") for k in bad],
        *[F.min(f"`p:{k}`").alias(f"p:{k}") for k in bad],
    ).select(*PAGE, "page.*", "n_rows", "n_identical", "n_seen", *[F.col(f"`{x}:{k}`") for k in [*bad, "indices-desalineados"] for x in "np"])
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    none = F.lit(None).cast("bigint")
    empty_search = F.col("is_search") & (F.coalesce(F.col("total"), F.lit(-1)) == 0) & F.col("marked_empty")

    def sign(kind: str, level: str, precedence: int, found: Column, amount: Column, pos: Column = none) -> Column:
        return F.when(
            F.coalesce(found, F.lit(False)) & ~empty_search,
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(level).alias("level"),
                F.lit(precedence).alias("precedence"),
                amount.cast("bigint").alias("n"),
                pos.cast("bigint").alias("first_pos"),
            ),
        )

    def row_sign(kind: str, level: str, precedence: int) -> Column:
        amount = F.col(f"`n:{kind}`")
        return sign(kind, level, precedence, amount > 0, amount, F.col(f"`p:{kind}`"))

    want = expected_rows(F.col("total"), F.col("first"), F.col("page_size"))
    one = F.lit(1)
    signs = [
        sign("sin-iterador", "error", 0, ~F.col("has_component") & F.col("is_search") & F.lit(numbered_per_page), one),
        sign("sin-filas", "error", 0, ~F.col("has_component") & ~(F.col("is_search") & F.lit(numbered_per_page)), one),
        sign("page-size", "error", 1, F.col("widget_page_size") != F.col("page_size"), F.col("widget_page_size")),
        sign("sin-total", "error", 2, F.col("is_search") & F.col("total").isNull(), one),
        sign("total-inestable", "error", 3, F.col("is_search") & (F.col("previous_total") != F.col("total")), F.col("total")),
        sign("sin-filas", "error", 4, F.col("has_component") & (n == 0), one),
        sign("pagina-incompleta", "error", 5, (n > 0) & (n != want), n),
        row_sign("indices-desalineados", "error", 6),
        row_sign("columnas", "error", 7),
        row_sign("numeracion", "error", 8),
        row_sign("sin-uuid", "error", 9),
        row_sign("registro-invalido", "error", 10),
        sign("solapamiento", "error", 11, (n > 0) & (F.col("n_seen") == n), n),
        sign("filas_identicas", "aviso", 20, F.col("n_identical") > 0, F.col("n_identical")),
        sign("duplicados", "aviso", 21, (F.col("n_seen") > 0) & (F.col("n_seen") < n), F.col("n_seen")),
        sign("cabeceras", "aviso", 22, (F.size("headers") > 0) & (F.col("headers") != F.col("expected_headers")), one),
        sign("totales-distintos", "aviso", 23, F.col("label_total") != F.col("total"), F.col("label_total")),
        row_sign("sin_documento", "dato", 30),
        *[row_sign(flag, "dato", 31 + i) for i, flag in enumerate(FLAGS) if flag in bad],
    ]
    return p.select(*PAGE, F.explode(F.array_compact(F.array(*signs))).alias("s")).select(*PAGE, "s.*")


ROW_KINDS = ("columnas", "numeracion", "sin-uuid", "registro-invalido")


def first_sign(findings: DataFrame) -> DataFrame:
    """The sign that stops a harvester on each page: page signs come before row signs, and
    row signs go by row, then by precedence; overlap is looked at last."""
    is_row = F.col("kind").isin(*ROW_KINDS)
    stage = F.when(is_row, 1).when(F.col("kind") == "solapamiento", 2).otherwise(0)
    key = F.struct(stage, F.when(is_row, F.col("first_pos")).otherwise(0), F.col("precedence"))
    errors = findings.where("level = 'error'")
    return errors.groupBy(*PAGE).agg(F.min_by("kind", key).alias("kind"))


def discovery_signs(pages: DataFrame) -> DataFrame:
    """Pages that need a search or next-page control and show none.

    ``pages``: keys, ``needs_search, needs_next, search, next`` (commands found, or NULL).
    """
    kind = F.when(F.col("needs_search") & F.col("search").isNull(), "busqueda-no-descubierta").when(
        F.col("needs_next") & F.col("next").isNull(), "paginacion-no-descubierta"
    )
    return pages.withColumn("kind", kind).where("kind is not null")
