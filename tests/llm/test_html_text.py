import html
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.llm import html_text, queries
from strata.llm.html_text import main_text
from strata.llm.tables import read

SF = "/root/testdata/sf0.01"
LONG = "A sentence of an article, with commas, and some length to it so that it counts. "


def test_query_against_the_article_elements(spark):
    pages = {r.page_id: r.html for r in read(spark, SF, "pages").collect()}
    out = queries.op9_html_text(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())
        assert (r.text, r.n_chars) == (want, len(want))


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("plain text only", "plain text only"), ("<p>One<p>Two", "One Two"),
    ("<p>a<b>b</b>c &amp; &lt;d&gt; &#233;\n\n e</p>", "abc & <d> é e"),
    ("<script>var t='</p><p>no</p>';</script><p>yes</p>", "yes"),
    ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
    ("<div class='sidebar'><p>no, no, no</p></div><div class='content'><p>yes</p></div>", "yes"),
    ("<body class='has-sidebar'><div id=cookie-notice><p>no</p></div><article><h1>T</h1><p>yes</p><div class=comments><p>no</p></div></article></body>", "T yes"),
    ("<p>5 < 6 and a<b", "5 < 6 and a<b"),
    ("<article><p>unclosed <a href='x", "unclosed <a href='x"),
])
def test_small_pages(page, want):
    assert main_text(page) == want


def test_best_container_without_article():
    page = (f"<html><head><title>no</title></head><body><div class='menu'><a href=x>m</a></div><div><a href=1>link one</a> <a href=2>link two</a></div>"
            f"<div id='story'><h1>Title</h1><p>{LONG * 2}</p><form><p>no</p></form><p>{LONG}</p><ul><li>item</li></ul></div>"
            f"<div><ul><li><a href=3>other, stories, here</a></li></ul></div><footer>no</footer></body></html>")
    assert main_text(page) == " ".join(f"Title {LONG * 3} item".split())


def test_sections_are_siblings():
    page = f"<main><h1>T</h1><section><p>{LONG}</p></section><section><p>{LONG}</p></section><aside>no</aside></main>"
    assert main_text(page) == " ".join(f"T {LONG * 2}".split())


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x</p>"), (2, "u", ""), (2, "u", "<p>x</p>"), (3, "u", "<p>" + "w " * 200000), (4, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("n"))
    out = html_text.extract_pages(df).collect()
    assert sorted((r.text[:5], r.n_chars) for r in out) == sorted([("", 0), ("x", 1), ("", 0), ("x", 1), ("w w w", 399999), ("deep", 4)])
    assert html_text.extract_pages(df.limit(0)).count() == 0


MENU = "<div><ul><li><a href=1>one</a></li><li>|</li><li><a href=2>two</a></li></ul></div>"


@pytest.mark.parametrize("page,want", [
    ("<main>" + "".join(f"<section><h2>H{k}</h2><div><p>{k} {LONG}</p><p>{LONG}</p></div></section>" for k in range(3)) + "</main>",
     " ".join(f"H{k} {k} {LONG * 2}" for k in range(3))),
    ("<div id=c>" + "".join(f"<div><div><p>{k} {LONG}</p></div></div>" for k in range(10)) + "</div>",
     " ".join(f"{k} {LONG}" for k in range(10))),
    (f"<main><section><p>{LONG * 9}</p></section><section><p>Short.</p></section></main>", f"{LONG * 9} Short."),
    (f"<body>{MENU}<div><div><div><p>{LONG}</p></div></div>{MENU}<div><p>Late, and short.</p></div></div>{MENU}</body>", f"{LONG} Late, and short."),
    (f"<body><div>{MENU * 9}<div><div><p>first {LONG}</p></div></div></div><div>{MENU * 9}<div><div><p>{LONG}</p></div></div></div></body>",
     f"first {LONG * 2}"),
    (f"<div><article><div><div><p>{LONG * 9}</p></div></div></article>{MENU}<section><div><div><p>{LONG * 4}</p></div></div></section></div>",
     f"{LONG * 13}"),
])
def test_nested_text_is_whole_and_menus_are_left_out(page, want):
    assert main_text(page) == " ".join(want.split())


MB = 1 << 20


@pytest.mark.parametrize("unit", [
    "<a", "<a ", "<a href=\"", "\"<a\" ", "<![CDATA[", "<!", "<?x ", "</", "</b>", "<b>x", "<div>x", "<i><b>", "<div><b>x</i>", "<p>x<br>", "<!--",
    "see < it ", "<li>x", "<a href='x'>y", "&amp", "<td><table>"])
def test_a_megabyte_of_anything_takes_seconds(unit):
    began = time.process_time()
    main_text("<article>" + unit * (MB // len(unit)))
    main_text("<div><p>words, words</p>" + unit * (MB // len(unit)) + "\">")
    main_text("see <" + unit * 20 + "x" * MB)
    assert time.process_time() - began < 40


def test_broken_quotes_lose_no_text():
    assert main_text("<p>one</p><a title=\"x>two</a><p>three</p>") == "one two three"
    assert main_text("<p>one</p><p title='x'>two <a href='y>three</a></p>") == "one two three"
