import html
import re

import pandas as pd
import pytest
from brute import SMALL

from noticeflow.llm.extract import extract, main_text, op4_text_density

LONG = "Words of an article that go on for a while, with some more words at its end. " * 3
LONG = " ".join(LONG.split())


def plain_article(source):
    """The pages of the test tables have one article element; its blocks, cut by hand."""
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", " " if "<br>" in b else "", b)).split()) for b in blocks]
    return "\n".join(line for line in lines if line)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_given_pages(spark, folder):
    path = f"/root/testdata/{folder}"
    pages = pd.read_parquet(f"{path}/pages.parquet").set_index("page_id")
    rows = op4_text_density(spark, path).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain_article(pages.html[r.page_id])
        assert (r.url, r.n_chars) == (pages.url[r.page_id], len(r.text))


CASES = {
    "divisions": f"<body><div id=top-menu><a href=/>Home</a> <a href=/x>About us</a></div><div class='body-text'><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div></body>",
    "no article element": f"<html><body><ul><li><a href=1>One link</a><li><a href=2>Two link</a></ul><div><div><p>{LONG}<p>{LONG}</div></div><div><a href=3>{LONG}</a></div></body></html>",
    "comments": f"<main><h1>Head</h1><p>{LONG}</p><section id=comments><p>{LONG} Reader</p></section></main>",
    "form around": f"<body><form><div><p>{LONG}</p></div><input name=q><select><option>no</select></form></body>",
    "header with title": f"<article><header><h1>Head</h1></header><p>{LONG}</p></article><header><p>Site</p></header>",
    "notice": f"<body><div role=alert><p>{LONG}</p></div><article><p>{LONG}</p></article><div class='cookie-notice'>{LONG}</div></body>",
}
WANT = {
    "divisions": ["Head", LONG, "Short.", LONG],
    "no article element": [LONG, LONG],
    "comments": ["Head", LONG],
    "form around": [LONG],
    "header with title": ["Head", LONG],
    "notice": [LONG],
}


@pytest.mark.parametrize("name", list(CASES))
def test_layouts(name):
    assert main_text(CASES[name]) == "\n".join(WANT[name])


def test_markup():
    page = f"<article><p>a&amp;b &lt;c&gt; &eacute;&#233;\n\t x<!-- <p>no</p> --><b>bo</b>ld<br>y &nbsp; z <script>if (a</p>) '</b>'</script>{LONG}"
    assert main_text(page) == f"a&b <c> éé xbold y z {LONG}"
    assert main_text(f"<p title='a>b' alt=\"<i>\">{LONG}</p>") == LONG
    assert main_text(f"<p title='open>{LONG}") == LONG
    assert main_text("<table><tr><td>a<td>b<tr><td>c</table>").split("\n") == ["a", "b", "c"]


def test_defined_cases(spark):
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    long = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (2, "u", "just text"), (None, "v", deep), (4, "w", long), (5, "x", "<<>< & <a"), (6, "y", "<nav>no</nav>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    got = [(r.page_id, r.url, r.text) for r in extract(frame).collect()]
    assert got[:4] == [(1, None, ""), (2, "u", ""), (2, "u", "just text"), (None, "v", LONG)]
    assert got[4][2] == "\n".join([LONG] * 3000)
    assert got[6][2] == ""
    assert extract(frame.limit(0)).count() == 0
