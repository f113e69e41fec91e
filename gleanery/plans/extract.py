"""Extraction jobs: landed bodies in, exploded rows out.

One pass of Arrow batches reads each body's elements; everything after it is column work
on the arrays that come out, so a page's rows need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from gleanery.functions import identity, markup, tree
from gleanery.functions.text import normalize_ws, ruling_year, split_multivalue, strip_session_url

TYPED_COLUMNS = 7  # fixed value: cells of a typed row

PARTS = {
    "headers": "array<string>",
    "indexed_rows": "array<struct<mark:string,cells:array<string>,onclick:string>>",
    "named_rows": "array<struct<number:string,iterator:string,cells:array<string>,text:string,onclick:string>>",
    "controls": "array<struct<tag:string,label:string,onclick:string,href:string>>",
    "forms": "array<struct<form_id:string,action:string,fields:array<struct<name:string,values:array<string>>>,token:string>>",
    "page_token": "string",
    "paginator_text": "string",
    "page_text": "string",
}


def spread(pages: DataFrame, key: str) -> DataFrame:
    """Pages dealt over as many tasks as shuffles have. A small file is read in one task, whatever the number of its pages, and reading
    bodies is heavy; where bodies are put together from narrow columns, those are what to deal out."""
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def page_parts(pages: DataFrame, body: str, parts: list[str], url: str | None = None) -> DataFrame:
    """The columns of ``pages`` but the body, and one column per part asked for. Pages are read where they lie (see :func:`spread`)."""
    keep = [f for f in pages.schema if f.name != body]
    read_out = StructType.fromDDL(", ".join(f"{p} {PARTS[p]}" for p in parts))
    types = {f.name: to_arrow_type(f.dataType) for f in read_out}

    def read(part: str, root, address: str):
        if part == "page_text":
            return root.text()
        return tree.forms(root, address) if part == "forms" else getattr(tree, part)(root)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            addresses = batch.column(url).to_pylist() if url else [""] * batch.num_rows
            found: dict[str, list] = {part: [] for part in parts}
            for text, address in zip(batch.column(body), addresses):  # one tree at a time
                root = tree.parse(text.as_py())
                for part in parts:
                    found[part].append(read(part, root, address))
            columns = {f.name: batch.column(f.name) for f in keep} | {part: pa.array(found[part], types[part]) for part in parts}
            yield pa.RecordBatch.from_pydict(columns)

    return pages.mapInArrow(batches, StructType([*keep, *read_out]))


def js_integer(text: Column) -> Column:
    """Integer that a numeric text stands for; blank is 0, anything else NULL."""
    value = normalize_ws(text)
    number = F.when(value.rlike(r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$"), value).try_cast("double")
    return F.when(value == "", F.lit(0).cast("bigint")).when(number == F.floor(number), number.try_cast("bigint"))


def typed_rows(parsed: DataFrame) -> DataFrame:
    """Rows of ``indexed_rows``: position, printed number, fields (only with all cells), link."""
    keep = [c for c in parsed.columns if c not in PARTS]
    rows = parsed.select(*keep, F.posexplode("indexed_rows").alias("pos", "r"))
    rows = rows.withColumn("_command", markup.click_command(F.col("r.onclick")))
    cells = F.col("r.cells")
    whole = F.size(cells) == TYPED_COLUMNS

    def cell(i: int) -> Column:
        return F.when(whole, F.get(cells, F.lit(i)))

    return rows.select(
        *keep,
        "pos",
        js_integer(F.col("r.mark")).alias("indice"),
        js_integer(F.get(cells, F.lit(0))).alias("nro"),
        F.size(cells).alias("columnas"),
        normalize_ws(cell(1)).alias("expediente"),
        split_multivalue(cell(2)).alias("administrados"),
        normalize_ws(cell(3)).alias("unidadFiscalizable"),
        normalize_ws(cell(4)).alias("sector"),
        normalize_ws(cell(5)).alias("resolucion"),
        ruling_year(normalize_ws(cell(5))).alias("anioResolucion"),
        markup.document_link(F.col("r.onclick"), F.col("_command")).alias("documento"),
    ).where("indice is not null")


def typed_records(rows: DataFrame, fuente: str, pagina: Column, captured_at: Column) -> DataFrame:
    """Whole typed rows as records with their identity."""
    uuid = F.col("documento.uuid")
    fields = ["expediente", "administrados", "unidadFiscalizable", "sector", "resolucion"]
    return rows.where(F.col("columnas") == TYPED_COLUMNS).select(
        F.lit(fuente).alias("fuente"),
        identity.typed_id(*[F.col(c) for c in fields], uuid).alias("id"),
        "indice",
        pagina.alias("pagina"),
        captured_at.alias("capturadoEn"),
        uuid.alias("documentoUuid"),
        *fields,
        "anioResolucion",
    )


def free_rows(parsed: DataFrame) -> DataFrame:
    """Rows of ``named_rows``: number, whole text, cells by header, link. Textless rows go."""
    keep = [c for c in parsed.columns if c not in PARTS]
    heads = F.transform("headers", normalize_ws)
    rows = parsed.withColumn("headers", heads).select(*keep, "headers", F.explode("named_rows").alias("r"))
    rows = rows.withColumn("_command", markup.click_command(F.col("r.onclick")))
    cells = F.transform("r.cells", normalize_ws)
    return rows.select(
        *keep,
        F.col("r.number").try_cast("bigint").alias("indice"),
        F.col("r.iterator").alias("iterador"),
        normalize_ws(F.col("r.text")).alias("texto"),
        cells.alias("celdas"),
        markup.label_cells(cells, F.col("headers")).alias("campos"),
        markup.document_link(F.col("r.onclick"), F.col("_command")).alias("documento"),
    ).where("texto <> ''")


def free_records(rows: DataFrame, fuente: str, pagina: Column, first: Column, captured_at: Column) -> DataFrame:
    """Schemaless rows as records; the site numbers rows per page, records count on."""
    uuid = F.col("documento.uuid")
    return rows.select(
        F.lit(fuente).alias("fuente"),
        identity.free_id(F.col("texto"), uuid).alias("id"),
        (first + F.col("indice")).alias("indice"),
        pagina.alias("pagina"),
        captured_at.alias("capturadoEn"),
        uuid.alias("documentoUuid"),
        "campos",
        "texto",
    )


def form_fields(parsed: DataFrame) -> DataFrame:
    """One row per page, form and submitted field; the token only as present or not."""
    keep = [c for c in parsed.columns if c not in PARTS]
    forms = parsed.select(*keep, F.explode("forms").alias("f"))
    return forms.select(
        *keep,
        F.col("f.form_id").alias("form_id"),
        strip_session_url(F.col("f.action")).alias("action"),
        F.col("f.token").isNotNull().alias("has_token"),
        F.explode("f.fields").alias("field"),
    ).select(*keep, "form_id", "action", "has_token", "field.name", "field.values")


def labelled_control(parsed: DataFrame, label_pattern: str) -> DataFrame:
    """Per page, the first control whose label matches and whose command can be read."""
    keep = [c for c in parsed.columns if c not in PARTS]
    first = _first_control(label_pattern)
    return parsed.select(*keep, first["label"].alias("label"), first["command"].alias("command"))


def labelled_commands(parsed: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Per page, the command of the first control for each label pattern, in a column of the name given; pages are read once."""
    keep = [c for c in parsed.columns if c not in PARTS]
    return parsed.select(*keep, *[_first_control(p)["command"].alias(name) for name, p in patterns.items()])


def _first_control(label_pattern: str) -> Column:
    fitting = F.filter(
        F.transform(
            F.filter("controls", lambda c: c["onclick"].isNotNull() & c["label"].rlike(label_pattern)),
            lambda c: F.struct(c["label"].alias("label"), markup.click_command(c["onclick"]).alias("command")),
        ),
        lambda c: c["command"].isNotNull(),
    )
    return F.get(fitting, F.lit(0))


# Fixed patterns: labels of the search control and of the next-page control.
SEARCH_LABEL = r"(?i)^\s*buscar\s*$"
NEXT_LABEL = r"(?iu)^\s*(?:siguiente|next|ir a la p[áa]gina siguiente)\s*$"
