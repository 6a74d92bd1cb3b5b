"""Main text of pages by template deduction."""

import html
import re

import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import pages
from ledgerweave.llm.common import table

SF = "/root/testdata/sf0.001"


def page(n, body):
    return (
        f"<!DOCTYPE html><html><head><title>T{n}</title><script>if (a<b) x('</p>');</script></head><body>"
        f"<nav><ul><li><a href='/{n}'>Menu {n}</a></li><li>More</ul></nav><div class='cookie-notice'>We use {n}</div>"
        f"<div id=wrap>{body}<aside>Side {n}</aside></div><section class=\"comments\"><p>A reader says {n}</section>"
        f"<footer>&copy; {n}</footer></body></html>"
    )


ARTICLE = "<h1>Head {0}</h1><p>One <b>bold</b>\n  word{0} &amp; more<br>line<p>Two {0}<ul><li>x<li>y{0}</ul><form>Mail</form>tail {0}"
WANT = "Head {0}\nOne bold word{0} & more line\nTwo {0}\nx\ny{0}\ntail {0}"


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=post-body>", "</div>"), ("<div class=zz>", "</div>")])
def test_articles_of_one_host(spark, open_, close):
    rows = [(i, "http://h.example/x", page(i, open_ + ARTICLE.format(i) + close), "clash") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert {r.page_id: r.text for r in pages.extract(df).collect()} == {i: WANT.format(i) for i in range(5)}


def test_template_of_a_host(spark):
    rows = [(i, "http://H.example:80/x?y", page(i, "<article>" + ARTICLE.format(i) * (i + 1) + "</article>")) for i in range(4)]
    found = pages.deduce_templates(spark.createDataFrame(rows, "page_id long, url string, html string")).first()
    assert found.host == "h.example:80" and found.slot.endswith("/article")
    assert found.slot in found.skeleton and not any(p.endswith("/h1") for p in found.skeleton)
    article = next(group for group in found.nested if any(p.endswith("/h1") for p in group))
    assert any(p.endswith("/ul") for p in article) and any(p.endswith("/b") for p in article)


def test_pages_alone_nulls_and_broken_markup(spark):
    rows = [
        (1, None, None),
        (2, "not a url", ""),
        (3, "http://one/a", "plain &lt;text&gt; only"),
        (4, "http://two/a", "<div><p>unclosed <i>one<p>two</div></div></p><"),
        (5, "http://three/a", "<article><p>" + "long " * 50_000 + "</article>"),
        (5, "http://three/a", "<article><p>" + "long " * 50_000 + "</article>"),
        (6, "http://four/a", "<!-- <p>no</p> --><p>1 < 2 &nbsp; 3</p>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [(r.page_id, r.text) for r in pages.extract(df).orderBy("page_id").collect()]
    long = " ".join(["long"] * 50_000)
    assert found == [(1, ""), (2, ""), (3, "plain <text> only"), (4, "unclosed one\ntwo"), (5, long), (5, long), (6, "1 < 2 3")]
    assert pages.extract(df.limit(0)).count() == 0


def test_pages_of_the_table_equal_brute_force(spark):
    given = table(spark, SF, "pages")
    for row in pages.extract(given).select("html", "text").collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = (re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", article))
        assert row.text == "\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def test_hosts(spark):
    urls = ["HTTP://A.b:8/c", "https://x", "//x/y", "", None, "ftp://u?q"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(pages.host_of(F.col("u"))).collect()] == ["a.b:8", "x", "", "", "", "u"]
