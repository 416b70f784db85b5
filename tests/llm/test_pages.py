import html
import re

import pytest

from yearloom.llm import pages as pg

FOLDER = "/root/testdata/sf0.001"


def text_of(source):
    """Text of a page that stands alone."""
    _, around, pieces = pg.Page(source).parts()
    keys = ("text", "border", "part", "other", "inside")
    return pg._joined([dict(zip(keys, p, strict=True)) for p in pieces], around, set())


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_given_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        want[r.page_id] = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
    got = pg.extract(pages)
    assert texts(got) == want
    assert all(r.n_chars == len(r.text) for r in got.collect())


@pytest.mark.parametrize(("source", "text"), [
    ("", ""), ("plain", "plain"), ("a<b", "a"), ("a < b", "a < b"), ("1<2", "1<2"), ("a &amp; &#233;&eacute; &nosuch; &amp", "a & éé &nosuch; &"),
    ("<p>a<p>b", "a b"), ("<b>a</b>b <i>c</i>", "ab c"), ("a<br>b", "a b"), ("<p>a\n\t b&nbsp;c</p>", "a b c"),
    ("<ul><li>a<li>b</ul>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<script>if (a<b) '</p>'</script>x<style>p{}</style>y<!-- z -->", "xy"), ("<title>t</title><p>x", "x"),
    ("<script>never closed", ""), ("x<!-- never closed", "x"), ("x<div never closed", "x"), ("<p title='a>b'>x</p>", "x"),
    ("<p title=it's>x</p> y", "x y"), ("<nav>n</nav><main><p>m</p></main><p>o", "m"),
    ("<header>h</header><p>x</p><footer>f</footer>", "x"),
    ("<main>m<article>a<aside>s</aside><p class='share-box'>t</p><header><h1>h</h1></header></article></main>", "a h"),
    ("<article>a</article><article class=comment>c</article><article>b</article>", "a b"),
    ("<div class='content with-sidebar'><article>a</article></div>", "a"),
    ("<div class=related><article>r</article></div><article>a</article>", "a"),
    ("<div id=commentsList>c</div><div class='Cookie_Notice'>k</div><div class=ad>d</div><div class=made>x</div>", "x"),
    ("<div role=navigation>n</div><div role=main>m</div>", "m"), ("<div hidden>h</div><p style='display: none'>d</p>x", "x"),
    ("<article><p>a</div>b</article>", "ab"), ("<HTML><HEAD><TITLE>t</TITLE></HEAD><BODY><P>x</BODY></HTML>", "x"),
    ("<head><meta charset=utf-8><p>x", "x"), ("<aside><article>n</article></aside>y", "y"), ("<form>f<p>g</form>x", "x"),
    ("<custom-box>a</custom-box>b", "a b"), ("</p>a</div></b>", "a"),
])
def test_single_pages(source, text):
    assert text_of(source) == text


def test_long_and_deep_pages_are_read_in_linear_time():
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000
    assert text_of(deep) == "x"
    assert len(text_of("<div>y " * 20_000)) == 39_999
    assert text_of("<p>word " * 200_000).count(" ") == 199_999
    assert text_of("<a " * 100_000) == "" and text_of('<a b="' * 50_001) == ""


def site(n=30):
    """Nameless menus, banners and articles: one menu for all pages, one for every third, a quoted paragraph."""
    rows = []
    for i in range(n):
        menu = "<div><div><a>Home</a></div><div><a>News</a></div></div>"
        section = f"<div><p>Section {i % 3}</p></div>"
        quote = "<p>Everyone quotes this.</p>" if i % 2 else ""
        rows.append((i, f"https://a.example.org/{i}?x=1", f"{menu}{section}<div><p>Own text {i}.</p>{quote}</div><div>Imprint</div>"))
        rows.append((100 + i, f"http://user@B.example.org:80/{i}", f"{menu}{section}<article><p>Own text {i}.</p>{quote}</article>"))
    return rows


def test_recurring_subtrees_go_but_not_from_articles(spark):
    df = spark.createDataFrame(site(), "page_id long, url string, html string")
    got = pg.extract(df, least_pages=8, least_share=0.2)
    own = texts(got)
    assert own[0] == "Own text 0." and own[1] == "Own text 1."  # quoted on 15 of 30 pages outside an article
    assert own[100] == "Own text 0." and own[101] == "Own text 1. Everyone quotes this."
    templates = {r.page_id: r.n_templates for r in got.collect()}
    assert templates[0] == 8 and templates[1] == 9 and templates[100] == 7
    rare = texts(pg.extract(df, least_pages=8, least_share=0.4))
    assert rare[0] == "Section 0 Own text 0."


def test_copies_count_once_and_hosts_apart(spark):
    page = "<div><p>Same words on every copy.</p></div>"
    rows = [(i, "http://c.org/", page) for i in range(50)]
    rows += [(100 + i, f"http://h{i}.org/", f"<p>Shared.</p><p>{i}</p>") for i in range(30)]
    rows += [(200 + i, None, f"<p>Shared.</p><p>{i}</p>") for i in range(30)]
    own = texts(pg.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)))
    assert own[3] == "Same words on every copy." and own[105] == "Shared. 5" and own[205] == "Shared. 5"


def test_any_split_gives_the_same_texts(spark):
    df = spark.createDataFrame(site(), "page_id long, url string, html string")
    assert texts(pg.extract(df.repartition(9))) == texts(pg.extract(df.coalesce(1)))


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (2, "", "", 2), (None, "no host", "<p>x", 3), (3, "http:///x", "<b>é</b> ", 4), (3, "http:///x", "<b>é</b> ", 4),
            (4, "http://h/", "<p>" + "word " * 100_000, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in pg.extract(df).collect()), key=str)
    assert [(r[0], r[2][:4], r[3], r[4]) for r in got] == [
        (1, "", 0, 0), (2, "", 0, 0), (3, "é", 1, 0), (3, "é", 1, 0), (4, "word", 499_999, 0), (None, "x", 1, 0)]
    assert pg.extract(df.limit(0)).collect() == []


def test_hosts():
    assert [pg.host_of(u) for u in ("HTTP://u:p@A.b:8/x", "//c.d?x", "e.f/g", "", None, "mailto:x@y")] == ["a.b", "c.d", None, None, None, None]
