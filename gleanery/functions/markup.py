"""What can be read from a response body without building a tree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_MARK = "ui-datatable-empty-message"  # fixed value: class of an empty result

# Fixed patterns: a script-submitted link, its form, and its quoted pairs.
_CALL = r"mojarra\.jsfcljs\(([^{]*)\{([^}]*)\}"
_PAIR = r"'([^']*+)'\s*+:\s*+'([^']*+)'"  # after _HELD: an alternation under a star would recurse once per character
_FORM = r"getElementById\(\s*'([^']+)'"
# Fixed pattern: id of a view token.
_TOKEN_ID = r"(?:^|:)(?:javax|jakarta)\.faces\.ViewState(?::|$)"

COMMAND_TYPE = "struct<form_id:string,params:map<string,string>>"


def _capture(text: Column, pattern: str, group: int = 1) -> Column:
    """One group of the first match, NULL where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _count(digits: Column) -> Column:
    return F.regexp_replace(digits, "[.,]", "").try_cast("bigint")


# What widgets and phrases of the portals look like.
WIDGET_TOTAL = r"rowCount:\s*(\d+)"
WIDGET_PAGE_SIZE = r"paginator:\s*\{[^}]*\brows:\s*(\d+)"
PAGINATOR_LABEL = r"(?i)(\d+)\s+de\s+([\d.,]+)\s*\(\s*([\d.,]+)\s+registros?\s*\)"
TOTAL_PHRASES = (
    r"(?i)(?:se\s+)?encontraron\s+([\d.,]+)",
    r"(?i)([\d.,]+)\s+resultados?\b",
    r"(?i)\(\s*([\d.,]+)\s+registros?\s*\)",
)
ROW_INDEX = r'data-ri="(\d+)"'


def widget_total(html: Column) -> Column:
    return _capture(html, WIDGET_TOTAL).try_cast("bigint")


def widget_page_size(html: Column) -> Column:
    return _capture(html, WIDGET_PAGE_SIZE).try_cast("bigint")


def paginator_label(label: Column) -> Column:
    """Page, page count and total of a "page 3 of 176 (1.753 records)" label, or NULL."""
    page = _capture(label, PAGINATOR_LABEL, 1).try_cast("bigint")
    pages, total = _count(_capture(label, PAGINATOR_LABEL, 2)), _count(_capture(label, PAGINATOR_LABEL, 3))
    return F.when(
        page.isNotNull(), F.struct(page.alias("page"), pages.alias("pages"), total.alias("total"))
    )


def text_total(text: Column) -> Column:
    """Total that a results page states in words: the first of three phrases that holds a number."""
    return F.coalesce(*[_count(_capture(text, p)) for p in TOTAL_PHRASES])


def is_empty_table(html: Column) -> Column:
    return F.contains(html, F.lit(EMPTY_MARK))


def row_indices(html: Column) -> Column:
    found = F.regexp_extract_all(html, F.lit(ROW_INDEX), F.lit(1))
    return F.transform(found, lambda d: d.try_cast("bigint"))


def _last_of_each(pairs: Column) -> Column:
    """Pairs ``k, v`` with the last value of each key, whatever the session's map policy.

    A fold, because a filter that looks at the whole list would evaluate it per element.
    """
    start = F.array().cast("array<struct<k:string,v:string>>")
    return F.aggregate(pairs, start, lambda kept, p: F.concat(F.filter(kept, lambda a: a["k"] != p["k"]), F.array(p)))


# Three code points that no text may hold stand for escaped signs while quotes are matched.
_HELD = {"\\\\": "\ufdd0", "\\'": "\ufdd1", '\\"': "\ufdd2"}


def _hold(js: Column) -> Column:
    for escaped, sign in _HELD.items():  # the backslash first: pairs are read from the left
        js = F.replace(js, F.lit(escaped), F.lit(sign))
    return js


def _release(js: Column) -> Column:
    return F.translate(js, "\ufdd0\ufdd1\ufdd2", "\\'\"")


def _unescape(js: Column) -> Column:
    return _release(_hold(js))


def _read_call(js: Column) -> Column:
    head, body = F.regexp_extract(js, _CALL, 1), _hold(F.regexp_extract(js, _CALL, 2))
    names = F.regexp_extract_all(body, F.lit(_PAIR), F.lit(1))
    values = F.regexp_extract_all(body, F.lit(_PAIR), F.lit(2))
    pairs = F.zip_with(names, values, lambda k, v: F.struct(_release(k).alias("k"), _release(v).alias("v")))
    params = F.map_from_entries(_last_of_each(pairs))
    return F.when(
        F.size(names) > 0, F.struct(_capture(head, _FORM).alias("form_id"), params.alias("params"))
    )


def click_command(onclick: Column) -> Column:
    """Form and parameters that a script-submitted link would post, or NULL.

    Tried as it stands, then with one level of escaping removed.
    """
    return F.coalesce(_read_call(onclick), _read_call(_unescape(onclick)))


def document_link(onclick: Column, command: Column | None = None) -> Column:
    """State of a row's document link: ``ok`` with its document, ``sin-enlace`` or ``ilegible``.

    The document is the value of the only pair whose name and value differ. Jobs over many
    rows pass the command as a column of its own, so that it is read once per row.
    """
    command = click_command(onclick) if command is None else command
    telling = F.filter(F.map_entries(command["params"]), lambda p: p["key"] != p["value"])
    found = F.size(telling) == 1
    state = F.when(onclick.isNull(), "sin-enlace").when(found, "ok").otherwise("ilegible")
    return F.struct(
        state.alias("estado"),
        F.when(found, F.get(telling, F.lit(0))["value"]).alias("uuid"),
        F.when(found, command["params"]).alias("comando"),
        F.when(found, command["form_id"]).alias("formulario"),
        F.when(state == "ilegible", onclick).alias("onclick"),
    )


def label_cells(cells: Column, headers: Column) -> Column:
    """Cells by header text; ``columnaN`` where there is none; a repeated header keeps the last cell."""
    labelled = F.transform(
        cells,
        lambda c, i: F.struct(
            F.coalesce(
                F.nullif(F.get(headers, i), F.lit("")),
                F.concat(F.lit("columna"), (i + 1).cast("string")),
            ).alias("k"),
            c.alias("v"),
        ),
    )
    return F.map_from_entries(_last_of_each(labelled))


def is_token_id(element_id: Column) -> Column:
    return element_id.rlike(_TOKEN_ID)


def token_shape(token: Column) -> Column:
    """Whether there is a view token and how long it is; never the token itself."""
    value = F.trim(token)
    present = F.coalesce(value != "", F.lit(False))
    return F.struct(present.alias("present"), F.when(present, F.length(value)).alias("length"))


def form_recognised(names: Column, known: list[str]) -> Column:
    """Does a form carry at least one of the known fields, bare or as ``container:field``?"""
    return F.exists(
        names,
        lambda n: n.isin(*known) | F.exists(F.array(*[F.lit(k) for k in known]), lambda k: F.endswith(n, F.concat(F.lit(":"), k))),
    )
