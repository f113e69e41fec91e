import random
import re

from gleanery.llm import common as C
from gleanery.llm import extraction as X

SF = "/root/testdata/sf0.01"


def text(html):
    return "\n".join(t for t, _ in X.lines(html))


def test_articles_of_the_pages(spark):
    """An article is made of the paragraphs of the document whose number ends its path, after a title."""
    docs = {r.doc_id: r.text for r in C.table(spark, SF, "documents").collect()}
    rows = X.op3_html_extraction(spark, SF).collect()
    assert len(rows) == C.table(spark, SF, "pages").count()
    for r in rows:
        number = int(re.search(r"/(\d+)", re.sub(r"^\w+://[^/]*", "", r.url))[1])
        want = "\n".join(p for p in (" ".join(p.split()) for p in docs[number].split("\n")) if p)
        assert r.text.split("\n", 1)[1] == want and r.n_chars == len(r.text)


def test_markup():
    assert text("<p>a&amp;b &lt;c&gt; &eacute;&#233;&#x41;<p>two<br>lines <b>bold</b>\n\t x") == "a&b <c> ééA\ntwo lines bold x"
    assert text('<nav>m</nav><script>var t="</p>";</script><style>p{}</style><!-- c <p>x -->text<!-- open') == "text"
    assert text("<header>h</header><main><header><h1>Title</h1></header><p>body</p></main><footer>f") == "Title\nbody"
    assert text('<div class="sidebar">s</div><div id="comments"><p>c</p></div><div role="alert">n</div><p class="ad">x<p>kept') == "kept"
    assert text('<form><input value="a>b">f</form><select><option>o</select><p title="a > b">ok</p>') == "ok"
    assert text("<nav><ul><li>open<article><p>still an article</article>") == "still an article"
    assert text("a < b and <unclosed attr='x") == "a < b and"
    assert text("") == "" and text("<<<>>>") != None  # noqa: E711
    assert text("<p hidden>h</p><p style='display:none'>d</p><p aria-hidden='true'>e</p>v") == "v"
    assert text("<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>") == "one\ntwo\nc1\nc2"
    assert len(text("<div>" * 20_000 + "deep")) == 4
    assert len(text("<p>" + "long " * 200_000)) == 999_999


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        found = sorted(X.shared(a, b))
        assert len(found) == lcs(a, b)
        rest = iter(b)
        assert all(any(a[i] == y for y in rest) for i in found)


def page(title, *body):
    return "<div>Site menu</div><div>News of the day</div>" + "".join(f"<div>{p}</div>" for p in (title, *body)) + "<div>Imprint</div>"


def test_shared_lines_go_where_no_container_tells(spark):
    rows = [
        (1, "http://h.org/a/1", page("One", "first story")),
        (2, "http://h.org/a/2", page("Two", "second story")),
        (3, "http://h.org/b/3", page("Three", "third story")),
        (4, "http://alone.org/x", page("Alone", "story")),
        (5, None, page("None", "story")),
        (6, "http://h.org/z/deep", None),
        (7, "http://h.org/c/9", "<article><p>quoted</p></article>"),
        (8, "http://h.org/c/8", "<article><p>quoted</p></article>"),
    ]
    rows.append(rows[0])
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, host int").repartition(4)
    got = {(r.page_id, r.text, r.n_chars) for r in X.extract(pages).collect()}
    texts = {i: t for i, t, _ in got}
    assert X.extract(pages).count() == len(rows) and all(n == len(t) for _, t, n in got)
    assert texts[1] == "One\nfirst story" and texts[2] == "Two\nsecond story" and texts[3] == "Three\nthird story"
    assert texts[4] == "Site menu\nNews of the day\nAlone\nstory\nImprint" and texts[5].startswith("Site menu")
    assert texts[6] == "" and texts[7] == texts[8] == "quoted"
    assert X.extract(pages.limit(0)).count() == 0


def test_containers_do_not_silence_the_rest_of_a_page(spark):
    cards = "<article><p>Related card</p></article>"
    rows = [
        (1, "http://h.org/a/1", page("One", "first long story about stones", cards)),
        (2, "http://h.org/a/2", page("Two", "second long story about rivers", cards)),
        (3, "http://i.org/a/1", page("Menu of one", "<article><p>quoted by both pages</p><p>a long text of its own</p></article>", "<article><p>Card</p></article>")),
        (4, "http://i.org/a/2", page("Menu of two", "<article><p>quoted by both pages</p><p>and another long text</p></article>", "<article><p>Card</p></article>")),
        (5, "http://j.org/a/1", "<div>12:01</div><article><p>an exact copy</p></article>"),
        (6, "http://j.org/a/2", "<div>12:02</div><main><article><p>an exact copy</p></article></main>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = {r.page_id: r.text for r in X.extract(pages).collect()}
    assert texts[1] == "One\nfirst long story about stones" and texts[2] == "Two\nsecond long story about rivers"
    assert texts[3] == "Menu of one\nquoted by both pages\na long text of its own" and texts[4] == "Menu of two\nquoted by both pages\nand another long text"
    assert texts[5] == "12:01\nan exact copy" and texts[6] == "12:02\nan exact copy"
    assert [c for _, c in X.lines("a<article>b<article>c</article>d</article>e<main>f</main>")] == [0, 1, 1, 1, 0, 2]


def test_long_pages_of_equal_lines_and_open_tags():
    """Constant work for each tag, and an alignment whose memory does not grow with the number of matches."""
    import time

    start = time.perf_counter()
    assert X.lines("<b>" * 20_000 + "</i>" * 20_000 + "x") == [("x", 0)]
    assert len(X.lines("<i>" * 20_000 + "<b>" * 20_000 + "</i>" * 20_000 + "<p>x" * 20_000)) == 20_000
    rng = random.Random(1)
    a, b = ([rng.randrange(3) for _ in range(12_000)] for _ in range(2))
    found = sorted(X.shared(a, b))
    rest = iter(b)
    assert all(any(a[i] == y for y in rest) for i in found) and len(found) > 8_000
    assert len(X.shared([7] * 30_000, [7] * 20_000)) == 20_000
    assert time.perf_counter() - start < 30


def test_alignment_in_linear_space(monkeypatch):
    rng = random.Random(6)
    for room in (1, 20, 100):
        monkeypatch.setattr(X, "ROOM", room)
        for _ in range(100):
            a, b = ([rng.randrange(5) for _ in range(rng.randrange(25))] for _ in range(2))
            found = sorted(X.shared(a, b))
            rest = iter(b)
            assert len(found) == lcs(a, b) and all(any(a[i] == y for y in rest) for i in found)


def test_a_form_around_the_page_does_not_drop_its_article():
    assert X.lines("<form><div>menu</div><article><p>story</p></article></form>") == [("story", 1)]
