import html
import re

import pytest

from folioforge.llm import site_trees as st
from folioforge.llm.plans import LLM_QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href="/">Home</a></header><nav><ul><li>Menu</ul></nav><!-- <p>no</p> --><div id="cookie-notice">We use cookies</div>
<div class="ad">Buy</div><main><article><header><h1>Big &amp; <em>bold</em></h1></header><p>One<br>two&nbsp; three
 four<p>Unclosed <b>bold<p>Next &lt;tag&gt; &#233;&notit;</p><script>var t="</p>";</script><ul><li>a<li>b</ul>
<form><input><p>Write</p></form><div class="share-buttons">Share</div><table><tr><td>x<td>y</table>
<section class="comments"><article class="comment"><p>First!</p></article></section></article></main>
<aside>Side</aside><div hidden>no</div><div role="dialog">no</div><footer>(c)</footer></body></html>"""


def test_parts_that_are_no_article():
    text = st.main_text(st.parse(PAGE))
    assert text == "Big & bold\nOne two three four\nUnclosed bold\nNext <tag> é¬it;\na\nb\nx y"


@pytest.mark.parametrize("source,text", [
    ("", ""), ("plain", "plain"), ("<p>a", "a"), ("<p>a</div>b", "a\nb"), ("<p title='a>b'>c", "c"), ("<p title=\"x>y", "y"),
    ("a < b <p>c", "a < b\nc"), ("<script>x", ""), ("<article></article><p>out", ""), ("<body><nav>m</nav><p>x</body>", "x"),
    ("<article class='post has-sidebar no-comments'><p>in</p></article>", "in"), ("<div class='with-menu'>x</div>", "x"),
    ("<article>a</article><article class='comment'>b</article>", "a"),
    ("<form><article><p>in</p></article></form>", "in"), ("<![CDATA[raw]]>", "raw"), ("<div>" * 300 + "deep", "deep"),
])
def test_broken_pages(source, text):
    assert st.main_text(st.parse(source)) == text


def test_query_against_the_pages_own_marks(spark, table):
    pages = {p["page_id"]: p for p in table(spark, "pages")}
    rows = LLM_QUERIES["op6_site_trees"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks)
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"])


def test_template_branches_are_learned_per_site(spark):
    def page(host, i, promo):
        own = f"<div class=body><p>story {i} of {host}</p><p>more {i * 7}</p></div>"
        return (i, f"https://{host}/{i}", f"<body><div class=top>{promo}</div>{own}<div class=x9>{promo}</div></body>")

    rows = [page("a.example", i, "Weather today") for i in range(20)] + [page("b.example", i, f"text {i}") for i in range(20)]
    rows += [page("c.example", 1, "Weather today")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["url"]): r["text"] for r in st.extract(df).collect()}
    assert got["https://a.example/3"] == "story 3 of a.example\nmore 21"
    assert got["https://b.example/3"] == "text 3\nstory 3 of b.example\nmore 21\ntext 3"
    assert got["https://c.example/1"].startswith("Weather today")


def test_copies_of_one_article_stay(spark):
    rows = [(i, f"https://a.example/{i}", "<body><p>top</p><article><p>same story</p></article></body>") for i in range(30)]
    got = st.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"same story"}


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, host string, paths string"
    rows = [(None, None, None, "t", "h", "p"), (1, "nonsense", "", None, None, None), (1, "http://h/", "<p>x</p>", "t", "h", "p"), (1, "http://h/", "<p>x</p>", "t", "h", "p")]
    got = sorted(map(repr, map(tuple, st.extract(spark.createDataFrame(rows, schema)).collect())))
    assert got == sorted(map(repr, [(None, None, "", 0), (1, "nonsense", "", 0), (1, "http://h/", "x", 1), (1, "http://h/", "x", 1)]))
    assert st.extract(spark.createDataFrame([], schema)).count() == 0
