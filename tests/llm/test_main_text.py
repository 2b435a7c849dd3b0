"""Main text of pages: given ones against what they were made of, planted sites, broken markup."""

from __future__ import annotations

import html
import random
import re
import time

import pytest

from tickmacro.llm import main_text as mt
from tickmacro.llm.markup import parse
from tickmacro.llm.queries import LLM_QUERIES


def test_given_pages_equal_their_articles(spark, sf_dir):
    """The given pages hold their article in one element, so regular expressions find it."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = LLM_QUERIES["op13_main_text"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [html.unescape(re.sub("<[^>]*>", "", p)) for p in re.split("<p>|</p>|</h1>|<br>", body)]
        assert r.text == "\n".join(" ".join(p.split()) for p in parts if p.split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def words(rng, n):
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(n))


def site(seed, count, wrap):
    """(url, html, text) of pages in one template without any telling name."""
    rng = random.Random(seed)
    for k in range(count):
        head, lines = words(rng, 6), [words(rng, rng.randrange(30, 80)) for _ in range(rng.randrange(2, 7))]
        article = f"<h1>{head}</h1>" + "".join(f"<p>{line[:20]}<i>{line[20:]}</i></p>" for line in lines)
        yield f"http://s{seed}.example.com/{k}", wrap(rng, k, article), "\n".join([head, *lines])


def anonymous(rng, k, article):
    menu = "".join(f"<li><a href='/{words(rng, 1)}'>{words(rng, 1)}</a>" for _ in range(5))
    return (
        f"<html><body><div class=x1><ul>{menu}</ul></div><div class=x2>We use cookies on page {k}. Agree?</div>"
        f"<div class=x3><div>Read all of it at leisure.</div>{article}</div>"
        f"<div class=x4><a href=/a>{words(rng, 3)}</a> <a href=/b>{words(rng, 3)}</a></div></body></html>"
    )


def named(rng, k, article):
    return (
        f"<html><head><title>{words(rng, 3)}</title></head><body class='has-sidebar'><header><p>{words(rng, 9)}</p></header>"
        f"<div id='cookie-banner'>{words(rng, 30)}</div><main><div class='post-content'>{article}"
        f"<div class='ad-slot'>{words(rng, 30)}</div><form><label>Mail</label><input></form></div>"
        f"<section id=comments><h2>Comments</h2><article class='comment'><p>{words(rng, 300)}</p></article></section></main>"
        f"<div class='sidebar'>{words(rng, 40)}</div><div class='site-footer'>{words(rng, 20)}</div></body></html>"
    )


def test_planted_sites(spark):
    rows = [*site(1, 12, anonymous), *site(2, 12, named), *site(3, 3, named)]
    pages = spark.createDataFrame([(k, u, h) for k, (u, h, _) in enumerate(rows)], "page_id long, url string, html string")
    found = {r.row.page_id: r.text for r in mt.extract(pages).collect()}
    for k, (_, _, text) in enumerate(rows):
        assert found[k] == text


def test_classes_are_tokens_that_occur_alike(spark):
    rows = [(u, h) for u, h, _ in site(1, 12, anonymous)]
    pages = spark.createDataFrame([*rows, *rows[:5]], "url string, html string")
    (row,) = mt.templates(mt.token_counts(pages)).collect()
    orders = [parse(h).tokens for _, h in rows]
    for tokens in row.classes:
        assert len({tuple(order.count(t) for order in orders) for t in tokens}) == 1
        assert all([order.index(t) for t in tokens] == sorted(order.index(t) for t in tokens) for order in orders)
    assert {t for order in orders for t in order if all(o.count(t) == 1 for o in orders)} == set(row.classes[0])


def test_near_copies_keep_their_article(spark):
    text = [words(random.Random(1), 40) for _ in range(5)]
    page = "<body><nav>menu</nav><article>" + "".join(f"<p>{t}</p>" for t in text) + "<p>{}</p></article></body>"
    pages = spark.createDataFrame([(f"http://a/{k}", page.format(f"copy {'i' * k}")) for k in range(12)], "url string, html string")
    assert {r.text.count("\n") for r in mt.extract(pages).collect()} == {5}


def test_crossing_classes_are_not_used():
    assert mt.valid([1, 4, 2, 5, 3, 6], [[1, 2, 3], [4, 5, 6]]) == {1, 2, 3}
    assert mt.valid([1, 4, 5, 6, 4, 5, 6, 2, 3], [[1, 2, 3], [4, 5, 6]]) == {1, 2, 3, 4, 5, 6}
    assert mt.valid([2, 1, 3], [[1, 2, 3]]) == set()


CASES = [
    ("", ""),
    ("plain text", "plain text"),
    ("<p>a &amp; b&nbsp;&#233; &lt;p&gt; &notanentity; x</p>", "a & b é <p> ¬anentity; x"),
    ("<p>a<br>b <b>c</b>d<p>e", "a b cd\ne"),
    ("<article>x<script>if (a<b) '</article>'</script>y<!-- <p>z</p> -->w</article>", "xyw"),
    ("<article><p title='a>b'>in</p></article><p>out</p>", "in"),
    ("<article><header><h1>T</h1></header><footer>f</footer><aside>s</aside>body</article>", "T\nbody"),
    ("<header>H</header><div class='has-menu'><p>text</p></div><div class='share-bar'>S</div>", "text"),
    ("<ul><li>one<li>two</ul><table><tr><td>1<td>2</table>", "one\ntwo\n1\n2"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("1 < 2 <3 and <a href=\"x\">unclosed", "1 < 2 <3 and unclosed"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_markup(page, text):
    assert mt.main_text(page) == text


def test_broken_markup_ends_in_time():
    began = time.perf_counter()
    for piece in ('<a "', "<", "</", "<p>", "<div>", "<!--", "<script>", "<ul><li>", "<b><i>", "</p ", "<td><b>", "&", "<h1>x"):
        mt.main_text(piece * 20_000)
    assert time.perf_counter() - began < 30


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, host string, row string, classes string, text string"
    rows = [(1, None, "<p>a</p>"), (2, "http://h/x", None), (None, "no host", "<p>b</p>"), (4, "http://h/", "")]
    rows += [(4, "http://h/", "<p>" + "long words " * 200_000 + "</p>")] * 2
    pages = spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], schema)
    out = mt.extract(pages).collect()
    assert sorted(len(r.text) for r in out) == [0, 0, 1, 1, 2_199_999, 2_199_999]
    assert out[0].row.asDict().keys() == set(pages.columns)
    assert mt.extract(pages.where("false")).count() == 0
