"""Main text of pages."""

import time

import pytest
from pyspark.sql import functions as F

from panelflow.llm.html_text import extract_main_text, main_text
from panelflow.llm.queries import QUERIES

LONG = "the quick brown fox jumps over the lazy dog and runs to the wood"

PAGES = {
    f"<body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>{LONG} &amp; more<br>after</article><footer>&copy; x</footer>": f"Title\n\n{LONG}\n\n{LONG} & more after",
    f"<header><h1>Site</h1></header><main><header><h1>Head</h1></header><div class='ad'>{LONG}</div><p>in<b>flat</b>ion {LONG}</p><p>Short.</p>"
    f"<aside>{LONG}</aside><section id=comments><article class=comment><p>{LONG}</p></article></section></main>": f"Head\n\ninflation {LONG}\n\nShort.",
    f"<div id='cookie-notice'>{LONG}</div><div><p>{LONG}</p><p>tiny</p><p>{LONG}</p></div><ul><li><a href='x'>one</a></li></ul>": f"{LONG}\n\ntiny\n\n{LONG}",
    f"<script>var a='</p><p>{LONG}';</script><style>p{{}}</style><!-- <p>{LONG}</p> --><p title='a>b'>x &lt; y {LONG}</p><form><p>{LONG}</p></form>": f"x < y {LONG}",
    f"<nav><li>{LONG}<article><p>{LONG}</p></article>": LONG,
    f"<p hidden>{LONG}</p><div style='display:none'>{LONG}</div><p>{LONG} a < b</p>": f"{LONG} a < b",
    "<p>zz zz zz zz zz zz zz zz zz zz zz zz</p>": "",
    "<article><p>zz zz zz zz zz zz zz zz zz zz zz zz</p></article>": "zz zz zz zz zz zz zz zz zz zz zz zz",
    f"<p>{LONG}</p><p>{LONG} &am": f"{LONG}\n\n{LONG} &am",
    f"<p>{LONG}</p><p>cut <a href": LONG + "\n\ncut",
    "": "",
    None: "",
}


@pytest.mark.parametrize("html", list(PAGES))
def test_pages(html):
    assert main_text(html)[0] == PAGES[html]


@pytest.mark.parametrize("unit", ["<", "<a \"", "<div>", "<!--", "<script>", "</p>", "<p class=\"", "&", "<b", "<title>", "<div class='ad'>x"])
def test_linear_time(unit):
    def took(n):
        start = time.perf_counter()
        main_text(unit * n)
        return time.perf_counter() - start

    took(1000)
    assert took(40_000) < 20 * max(took(10_000), 0.01)


def test_table(spark):
    rows = [(i, h, "x") for i, h in enumerate(PAGES)] + [(None, "<article>a</article>", None), (0, None, "x")]
    df = spark.createDataFrame(rows, "page_id int, html string, n_blocks string").withColumn("c0", F.lit(5))
    got = extract_main_text(df)
    assert got.columns == ["page_id", "c0", "text", "n_blocks", "n_dropped"] and got.count() == len(rows)
    assert extract_main_text(df.limit(0)).count() == 0


def test_query_keeps_articles(spark, sf):
    """The given pages hold their main text in one article element each."""
    import re
    from html import unescape

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op4_html_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"(?s)<article>(.*?)(?:</article>|$)", pages[r["page_id"]]["html"]).group(1)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", inside))
        want = [" ".join(unescape(re.sub(r"</?b>", "", p)).split()) for p in parts]
        assert r["text"] == "\n\n".join(w for w in want if w)
        assert r["n_chars"] == len(r["text"])
