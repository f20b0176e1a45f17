from __future__ import annotations

import math
import random
import time

import pytest

from recordforge.llm import html_text

LONG = "The council met on Tuesday evening to talk about the bridge, and nobody left before the vote was over."
PAGE = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body class="home">
<nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav><header>Site header</header>
<div class="cookie-notice">We use cookies on this site.</div><!-- <p>old</p> --><div class="ad">Buy &amp; save</div>
<article><h1>Bridge &lt;vote&gt;</h1><p>{LONG}<br>Second   line.<p>Next &amp paragraph with <a href=x>a link</a> &copy; 2020.
<form><input value=1>Send</form><ul><li>one<li>two</ul><aside>Side</aside></article>
<div id="comments"><p>{LONG} {LONG} {LONG}</p></div><footer>Footer &middot; text</footer></body></html>"""
TEXT = f"Bridge <vote>\n{LONG} Second line.\nNext & paragraph with a link © 2020.\none\ntwo"


def test_article_without_furniture():
    assert html_text.main_text(PAGE) == TEXT


def test_density_finds_unmarked_articles():
    page = f"<body><div><a href=1>Home</a> <a href=2>News</a></div><div id=x><div><p>{LONG}</p><p>{LONG} Again.</p></div></div><div><ul><li><a href=1>more</a><li><a href=2>less</a></ul></div></body>"
    assert html_text.main_text(page) == f"{LONG}\n{LONG} Again."


def test_broken_pages():
    assert html_text.main_text("<article><p>cut &am") == "cut &am"
    assert html_text.main_text(f"<article><p>{LONG}</p><p>b <a hre") == f"{LONG}\nb"
    assert html_text.main_text(f"<p>1 < 2 and {LONG}") == f"1 < 2 and {LONG}"
    assert html_text.main_text("plain text\n only") == "plain text only"
    for empty in (None, "", "<html><body></body></html>", "<nav>x</nav>", "<!-- x", "<script>a"):
        assert html_text.main_text(empty) == ""


def _five(k):
    return "".join(f"<p>{LONG} {k}{i}</p>" for i in range(5))


def _texts(k):
    return [f"{LONG} {k}{i}" for i in range(5)]


MENU = "<div><a href=1>Home</a> <a href=2>News</a> <a href=3>About</a></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{MENU}<div><section>{_five('a')}</section><section>{_five('b')}</section></div></body>",
        f"<body>{MENU}<div><article>{_five('a')}</article><article>{_five('b')}</article></div></body>",
        f"<body>{MENU}<div><div><div>{_five('a')}</div></div></div><div>{_five('b')}</div></body>",
        f"<body>{MENU}<article>{_five('a')}</article>{MENU}<article>{_five('b')}</article><div id=comments><article>{_five('c')}</article></div></body>",
        f"<body>{MENU}<main>{_five('a')}{_five('b')}<article class='comment'>{_five('c')}</article></main></body>",
    ],
)
def test_all_parts_of_an_article(page):
    assert html_text.main_text(page).split("\n") == _texts("a") + _texts("b")


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='content has-sidebar'>{}</div>", "<div id='page-with-banner'>{}</div>", "<div class='post comments-open'>{}</div>", "<form id='aspnetForm'>{}</form>",
        "<div class='widget-area sidebar-left'>{}</div>", "<div role=form>{}</div>", "<div class='no-comments is-promo'>{}</div>",
    ],
)
@pytest.mark.parametrize("element", ["article", "div", "main"])
def test_wrappers_that_are_named_like_furniture(wrapper, element):
    inner = f"{MENU}<{element}>{_five('a')}<form>Send <input></form><div class='share'>Share this</div></{element}><div class=sidebar>Side {LONG}</div>"
    assert html_text.main_text(f"<body>{wrapper.format(inner)}<footer>f</footer></body>").split("\n") == _texts("a")


def test_furniture_still_goes():
    for mark in ("class=sidebar", "id=comments", "class='x cookie-notice'", "role=navigation", "class='comment-list'", "hidden", "class='ad promo'"):
        page = f"<body><div {mark}>{_five('c')}{_five('d')}</div><article>{_five('a')}</article></body>"
        assert html_text.main_text(page).split("\n") == _texts("a"), mark


def test_headline_before_the_densest_block():
    page = f"<body>{MENU}<h1>The bridge</h1><h2>A vote</h2>\n<div><div>{_five('a')}</div></div><h3>Later</h3></body>"
    assert html_text.main_text(page).split("\n") == ["The bridge", "A vote", *_texts("a")]


def test_densities_equal_plain_recomputation():
    random.seed(9)

    def tree(depth):
        name = random.choice(["div", "p", "a", "b", "section"] if depth < 5 else ["p", "a"])
        inner = "".join(tree(depth + 1) if random.random() < 0.6 else f" {'word ' * random.randint(0, 9)}" for _ in range(random.randint(0, 4) if depth < 5 else 1))
        return f"<{name}>{inner}</{name}>"

    def count(node):
        chars = tags = link_chars = link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                chars += len("".join(c.split()))
            else:
                cc, ct, cl, clt = count(c)
                chars, tags, link_chars, link_tags = chars + cc, tags + ct + 1, link_chars + cl, link_tags + clt + (c.name == "a")
        return chars, tags, chars if node.name == "a" else link_chars, link_tags

    for _ in range(60):
        root = html_text.parse(f"<body>{''.join(tree(0) for _ in range(4))}</body>")
        order = html_text.measure(root)
        body = next(n for n in order if n.name == "body")
        cb, _, lcb, _ = count(body)

        def density(c, t, lc, lt):
            if c == 0:
                return 0.0
            some = lambda x: x if x else 1
            base = math.log(c / some(c - lc) * some(lc) + some(lcb) / some(cb) * c + math.e)  # noqa: B023
            return c / some(t) * math.log(c / some(lc) * some(t) / some(lt), base)

        for n in order:
            assert math.isclose(n.density, density(*count(n)), abs_tol=1e-9)
            own = sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
            expected = sum(density(*count(c)) for c in n.children if not isinstance(c, str)) + density(own, 1, own if n.name == "a" else 0, 0)
            assert math.isclose(n.sum, expected, abs_tol=1e-9)


def test_time_is_linear():
    started = time.time()
    html_text.main_text("<div>" * 50_000 + "x" + "<p>" * 20_000 + "</i>" * 20_000)
    html_text.main_text("<a '" * 100_000)
    html_text.main_text("<article><p>one two three</p></article>" * 30_000)
    html_text.main_text("<h1>x</h1><section><p>one two three</p></section>" * 20_000)
    html_text.main_text("<li>" * 50_000 + "<td>x" * 50_000 + "<!-- " * 50_000)
    assert time.time() - started < 30


def test_query_with_empty_table_and_odd_rows(spark, tmp_path):
    schema = "page_id long, url string, html string, n_chars string, text int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/pages.parquet")
    assert html_text.op3_html_text(spark, f"{tmp_path}/a").collect() == []
    spark.createDataFrame([(1, None, None, "x", 1), (None, "u", PAGE, "x", 1)], schema).write.parquet(f"{tmp_path}/b/pages.parquet")
    rows = {tuple(r) for r in html_text.op3_html_text(spark, f"{tmp_path}/b").collect()}
    assert rows == {(1, None, "", 0), (None, "u", TEXT, len(TEXT))}


def test_rows_and_columns_stay(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "own"), (2, None, None, "own"), (1, "u", PAGE, "own"), (None, "v", "<p>x</p>", "own")], "page_id long, url string, html string, text string")
    found = html_text.extract(df)
    assert found.columns == df.columns
    assert sorted((str(r["page_id"]), r["text"]) for r in found.collect()) == [("1", TEXT), ("1", TEXT), ("2", ""), ("None", "x")]
