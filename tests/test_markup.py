from pyspark.sql import functions as F

from gleanery.functions import markup


def test_widget_numbers(values):
    given = ["w({paginator:{id:['x'],rows:20,rowCount:1753,page:0}})", "scrollLimit:1753,rows:99", "rowCount: 7"]
    assert values(markup.widget_page_size, given) == [20, None, None]
    assert values(markup.widget_total, given) == [1753, None, 7]


def test_paginator_label(values):
    given = ["Página 3 de 1.760 (17.593 registros)", "1 de 1 (1 registro)", "Mostrando 1-10"]
    got = values(markup.paginator_label, given)
    assert [tuple(g) if g else None for g in got] == [(3, 1760, 17593), (1, 1, 1), None]


def test_text_total(values):
    given = ["Se encontraron 1.753 resultados", "Mostrando 10 de 300 resultados", "Página 1 de 5 (1,234 registros)", "nothing", "encontraron 5 y 9 resultados"]
    assert values(markup.text_total, given) == [1753, 300, 1234, None, 5]


def test_row_indices(values):
    assert values(markup.row_indices, ['<tr data-ri="3"><tr data-ri="12">', "none"]) == [[3, 12], []]


CALL = "mojarra.jsfcljs(document.getElementById('f:x'),{'f:a':'f:a','doc':'u-1'},'');return false"


def test_click_command(values):
    escaped = CALL.replace("'", "\\'")
    given = [CALL, escaped, "open(1)", "mojarra.jsfcljs(f,{},'')", "mojarra.jsfcljs(f,{'a':'1','a':'2'},'')", r"mojarra.jsfcljs(f,{'a':'it\'s'},'')", None]
    got = values(markup.click_command, given)
    assert [(g["form_id"], g["params"]) if g else None for g in got] == [
        ("f:x", {"f:a": "f:a", "doc": "u-1"}), ("f:x", {"f:a": "f:a", "doc": "u-1"}), None, None, (None, {"a": "2"}), (None, {"a": "it's"}), None,
    ]


def test_document_link(values):
    two = "mojarra.jsfcljs(f,{'a':'1','b':'2'},'')"
    same = "mojarra.jsfcljs(f,{'a':'a'},'')"
    got = values(markup.document_link, [CALL, None, "open(1)", two, same])
    assert [(g["estado"], g["uuid"]) for g in got] == [("ok", "u-1"), ("sin-enlace", None), ("ilegible", None), ("ilegible", None), ("ilegible", None)]
    assert got[2]["onclick"] == "open(1)" and got[0]["onclick"] is None


def test_label_cells(spark):
    df = spark.createDataFrame([(["a", "b"], ["Matter"]), (["a", "b", "c"], ["X", "", "X"]), ([], ["X"])], "c array<string>, h array<string>")
    got = [r[0] for r in df.select(markup.label_cells(F.col("c"), F.col("h"))).collect()]
    assert got == [{"Matter": "a", "columna2": "b"}, {"X": "c", "columna2": "b"}, {}]


def test_tokens(values):
    ids = ["javax.faces.ViewState", "j1:javax.faces.ViewState:0", "jakarta.faces.ViewState", "xjavax.faces.ViewState", "f:dt"]
    assert values(markup.is_token_id, ids) == [True, True, True, False, False]
    assert [tuple(t) for t in values(markup.token_shape, [" ab ", "", None])] == [(True, 2), (False, None), (False, None)]


def test_form_recognised(values):
    got = values(lambda c: markup.form_recognised(F.split(c, ","), ["year", "court"]), ["f:year,x", "court", "f:years", "x"])
    assert got == [True, True, False, False]


def test_long_values_and_many_escapes(values):
    """A value of a million characters, plain or escaped, is read like a short one."""
    long, escaped = "v" * 1_000_000, "\\'" * 500_000
    given = [f"mojarra.jsfcljs(f,{{'a':'{long}','b':'1'}},'')", f"mojarra.jsfcljs(f,{{'a':'{escaped}','b':'\\\\'}},'')"]
    got = values(lambda c: markup.click_command(c), given)
    assert got[0]["params"] == {"a": long, "b": "1"} and got[1]["params"] == {"a": "'" * 500_000, "b": "\\"}
