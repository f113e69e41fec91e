from pyspark.sql import functions as F

from gleanery.plans import extract
from gleanery.sources import responses

LINK = "<a onclick=\"mojarra.jsfcljs(document.getElementById('f'),{'b':'b','doc':'u1'},'')\">pdf</a>"


def row(n, cells, mark=None):
    return f'<tr data-ri="{n if mark is None else mark}">' + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


WHOLE = row(0, [1, " C-1 ", "Ann\n  Bob &amp; Co\n", "Unit", "Mines", "12-2014-R", LINK])


def parts(spark, body, names, url="http://h.example/a/"):
    df = spark.createDataFrame([(1, url, body)], "page_id int, url string, body string")
    return extract.page_parts(df, "body", names, "url")


def typed(spark, body):
    return [r.asDict(True) for r in extract.typed_rows(parts(spark, body, ["indexed_rows"])).orderBy("pos").collect()]


def test_typed_row(spark):
    (r,) = typed(spark, f"<table><thead><tr><th>No</th></tr></thead><tbody>{WHOLE}</tbody></table>")
    assert (r["indice"], r["nro"], r["columnas"], r["expediente"], r["resolucion"], r["anioResolucion"]) == (0, 1, 7, "C-1", "12-2014-R", 2014)
    assert r["administrados"] == ["Ann", "Bob & Co"]
    assert (r["documento"]["estado"], r["documento"]["uuid"], r["documento"]["formulario"]) == ("ok", "u1", "f")


def test_bare_rows_unclosed_cells_and_nested_tables(spark):
    bare = "<tr data-ri=5><td>6<td>c<td>p<td>u<td>s<td>r<td>x<tr data-ri=6><td>7<td><table><tr><td>in</td></tr></table>"
    a, b = typed(spark, bare)
    assert (a["indice"], a["columnas"], a["documento"]["estado"]) == (5, 7, "sin-enlace")
    assert (b["indice"], b["columnas"], b["expediente"]) == (6, 2, None)


def test_row_marks(spark):
    body = row(0, [1], "x") + row(0, ["n"], "") + row(0, ["2.0"], " 4 ")
    assert [(r["indice"], r["nro"]) for r in typed(spark, body)] == [(0, None), (4, 2)]
    assert typed(spark, None) == [] and typed(spark, "<<<>") == []


def test_typed_records(spark):
    rows = extract.typed_rows(parts(spark, WHOLE, ["indexed_rows"]))
    (r,) = extract.typed_records(rows, "src", F.lit(1), F.lit(None).cast("timestamp")).collect()
    import hashlib

    assert r["id"] == hashlib.sha1("C-1\0Ann|Bob & Co\0Unit\0Mines\00012-2014-R\0u1".encode()).hexdigest()[:24]
    assert (r["documentoUuid"], r["pagina"]) == ("u1", 1)


def test_named_rows(spark):
    body = (
        "<div><p>Se encontraron 1.753 resultados</p></div><table><thead><tr><th>Matter</th></tr></thead>"
        "<tr><td id='f:list:1:a'>second</td><td id='f:list:1:b'>x</td></tr>"
        "<tr><td><span id='f:list:0:a'>first</span></td><td>y</td></tr></table>"
        "<div>boxed <i name='f:list:2:a'>third</i></div><div><b id='f:list:3:z'> </b></div><p id='other'>no</p>"
    )
    p = parts(spark, body, ["named_rows", "headers", "page_text"])
    rows = [r.asDict(True) for r in extract.free_rows(p).collect()]
    assert [(r["indice"], r["texto"]) for r in rows] == [(0, "firsty"), (1, "secondx"), (2, "boxed third")]
    assert rows[0]["campos"] == {"Matter": "first", "columna2": "y"} and rows[2]["campos"] == {}
    assert {r["iterador"] for r in rows} == {"list"}
    recs = extract.free_records(extract.free_rows(p), "s", F.lit(3), F.lit(20), F.lit(None).cast("timestamp")).collect()
    assert [r["indice"] for r in recs] == [20, 21, 22]


def test_forms(spark):
    body = """<form><input name=a></form><form id="f" action="../go;jsessionid=9?x=1">
      <input name="t" value="1"><input name="t" value="2"><input type="checkbox" name="c1" value="on" checked><input type="radio" name="c2" value="on">
      <input type="submit" name="s" value="go"><input type="file" name="up"><input name="off" disabled value="1"><input value="nameless"><input name="empty">
      <select name="one"><option value="a">A<option value="b" selected>B</select><select name="first"><option>x<option>y</select>
      <select name="many" multiple><option value="1" selected>1<option value="2">2<option value="3" selected>3</select><select name="none" multiple><option>1</select>
      <textarea name="note">free &lt;text&gt;</textarea><input type="hidden" name="f:javax.faces.ViewState" value=" tok "></form>"""
    rows = extract.form_fields(parts(spark, body, ["forms"])).collect()
    assert {r["name"]: list(r["values"]) for r in rows} == {
        "t": ["1", "2"], "c1": ["on"], "empty": [""], "one": ["b"], "first": ["x"], "many": ["1", "3"], "note": ["free <text>"],
    }
    assert {(r["form_id"], r["action"], r["has_token"]) for r in rows} == {("f", "http://h.example/go?x=1", True)}


def test_labelled_control(spark):
    call = "mojarra.jsfcljs(document.getElementById('f'),{{'go':'{}'}},'')"
    body = (
        f'<a onclick="open(1)" title="Buscar">x</a><input type=button value=" BUSCAR " onclick="{call.format(1)}">'
        f'<button onclick="{call.format(2)}">Buscar</button><a onclick="{call.format(3)}" title="Ir a la página siguiente">&gt;</a>'
    )
    p = parts(spark, body, ["controls"])
    (s,) = extract.labelled_control(p, extract.SEARCH_LABEL).collect()
    (n,) = extract.labelled_control(p, extract.NEXT_LABEL).collect()
    (z,) = extract.labelled_control(p, "^none$").collect()
    assert (s["command"]["params"], n["command"]["params"], z["command"]) == ({"go": "1"}, {"go": "3"}, None)


def test_partial_responses(spark):
    ok = (
        '<?xml version="1.0"?>\n<partial-response id="p"><changes><update id="f:dt"><![CDATA[<tr>&amp;</tr>]]></update>'
        '<update id="g:list">old</update><update id="g:list">new</update><update id="j:javax.faces.ViewState:0"> t1 </update><eval>x</eval></changes></partial-response>'
    )
    bodies = [ok, '<partial-response><redirect url="/home"/></partial-response>',
              "<partial-response><error><error-name> E1 </error-name><error-message>gone</error-message></error></partial-response>",
              "<html>page</html>", "<partial-response><changes>", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    p = responses.partial_responses(df).withColumn("class", responses.response_class())
    got = p.withColumns({"exact": responses.find_update(F.col("updates"), "f:dt"), "tail": responses.find_update(F.col("updates"), "list"), "no": responses.find_update(F.col("updates"), "st")})
    r = [x.asDict(True) for x in got.orderBy("i").collect()]
    assert [x["class"] for x in r[:5]] == ["partial", "expired-redirect", "expired-error", "not-partial", "partial"]
    assert [u["id"] for u in r[0]["updates"]] == ["f:dt", "g:list", "j:javax.faces.ViewState:0"]
    assert (r[0]["exact"], r[0]["tail"], r[0]["no"], r[0]["token"]) == ("<tr>&amp;</tr>", "new", None, "t1")
    assert r[1]["redirect"] == "/home" and r[2]["error"] == {"name": "E1", "message": "gone"}
    assert r[4]["updates"] == [] and r[4]["token"] is None


def test_row_numbers_of_any_length(spark):
    body = f"<table><tr><td id='f:t:{'9' * 30}:x'>far</td></tr><tr><td id='f:t:002:x'>two</td></tr><tr><td id='f:t:2:y'>again</td></tr></table>"
    rows = extract.free_rows(parts(spark, body, ["named_rows", "headers"])).orderBy(F.col("indice").isNull()).collect()
    assert [(r["indice"], r["texto"]) for r in rows] == [(2, "two"), (None, "far")]


def test_pages_of_a_small_file_are_read_in_many_tasks(spark, tmp_path):
    """A form's body stands in no file; however small the customers' one is, its pages are dealt over the tasks of a shuffle."""
    from workload import tables as T

    customers = spark.range(400).selectExpr("id as c_custkey", "'c' || id as c_name", "'BUILDING' as c_mktsegment", "1 as c_nationkey", "1.0 as c_acctbal")
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    read = extract.page_parts(T.form_pages(spark, str(tmp_path)), "body", ["forms", "page_token"], "url")
    tasks = [r["n"] for r in read.groupBy(F.spark_partition_id()).agg(F.count("page_token").alias("n")).collect()]
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert sum(tasks) == 400 and max(tasks) < 200


def test_other_columns_keep_their_types(spark):
    pages = spark.sql("select array(named_struct('a', 1, 'b', date'2024-02-03')) x, timestamp_ntz'2024-01-01 00:00:01' t, map('k', 1.5) m, 'http://h/' u, cast(null as string) body")
    out = extract.page_parts(pages, "body", ["forms", "headers", "page_token"], "u")
    assert [f.dataType for f in out.schema][:4] == [f.dataType for f in pages.schema][:4]
    (got,) = out.collect()
    assert got[:4] == pages.first()[:4] and (got["forms"], got["headers"], got["page_token"]) == ([], [], None)
