import re
import time
from urllib.parse import urlsplit

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from paperledger.llm import html as h

SCHEMA = "page_id long, url string, html string, host string, text int"


def text(html):
    return h.page(html).main_text(set())


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("plain", "plain"),
    ("<p>one <u>two</u> three</p>", "one two three"), ("<p>p &lt; 0.05 if x < 3 then", "p < 0.05 if x < 3 then"),
    ("<article><h1>T &am</h1><p><b>a<br>b&nbsp;c\n d<p>e</p></article><footer>no", "T &am\n\na b c d\n\ne"),
    ("<body><nav><ul><li><a>m</a></ul></nav><div class='ad'>x</div><article>y<aside>z</aside><form><p>q</p></form>w</article>", "y\n\nw"),
    ("<header>h</header><main><header><h1>t</h1></header><p>a<script>var t='</p>';</script>b</main>", "t\n\nab"),
    ("<div id='cookie-notice'>x</div><p>a</p><!-- <p>b</p> --><div class=\"post-comments\"><p>c", "a"),
    ("<article>a</article><article class=comment>b</article><article>c</article>", "a\n\nc"),
    ("<article><p>a</p><article>b</article></article>", "a\n\nb"),
    ("<table><tr><td>1<td>2<tr><td>3</table><ul><li>x<li>y<ul><li>z</ul></ul>", "1\n\n2\n\n3\n\nx\n\ny\n\nz"),
    ("<b><p>a</b>b</p>c", "ab\n\nc"), ("<p>a</div>b", "ab"), ("a<hr>b", "a\n\nb"), ("<p hidden>a</p><p style='display: none'>b</p>c", "c"),
    ("&eacute;&#233;&#x1F600;&bogus;", "éé\U0001f600&bogus;"), ("<title>t</title><style>p{}</style>x", "x"),
    ("<div>" * 30000 + "deep", "deep"),
])
def test_blocks(html, want):
    assert text(html) == want


@given(st.text(alphabet="<>/pbdiv arcle&;=\"'! -x[]?", max_size=80))
def test_any_markup_parses(html):
    page = h.page(html)
    assert len(page.hashes()) == len(page.tags)
    page.main_text(page.candidates())


@pytest.mark.parametrize("html, want", [
    ("<p>if (a<![b]) then</p>", "if (a"), ("a<![if !IE]>b<![endif]>c", "abc"), ("a<![CDATA[ x > y ]]>b", "ab"), ("<!DOCTYPE [ x><p>a", "a"), ("<p>a <![x", "a <![x"),
])
def test_marked_sections_are_comments(html, want):
    assert text(html) == want


@pytest.mark.parametrize("html", [
    "<b>" * 20_000 + "</i>" * 20_000, "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000, "<a " * 60_000, "<!--" * 50_000, "<![" * 60_000, "</" * 80_000, "<?" * 80_000,
    "<a \"'<![x]=" * 15_000, "<!" * 80_000, "<p>" * 40_000, "".join(f"<a{i}>" for i in range(20_000)) + "</a1>" * 20_000, "<table><td>" * 15_000,
])
def test_any_soup_is_parsed_in_a_moment(html):
    start = time.perf_counter()
    found = h.page(html)
    found.main_text(found.candidates())
    assert time.perf_counter() - start < 6


def test_one_bad_page_leaves_all_rows(spark):
    rows = [(i, "http://a.example", f"<article><p>Text {i}</p></article>") for i in range(20)] + [(20, "http://a.example", "<p>if (a<![b]) then</p>")]
    got = {r.page_id: r.text for r in h.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Text {i}" for i in range(20)}, 20: "if (a"}


def test_templates_of_pages_without_articles(spark):
    """Given pages whose names are gone, boxes around the text are found by counting alone."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    want = {r.page_id: h.page(r.html).main_text(set()) for r in pages}
    bare = [(r.page_id, "http://one.example/", re.sub(r"(?s)<script.*?</script>|<style.*?</style>|<head.*?</head>", "", re.sub(r"(?i)<(/?)(article|main|header|footer|nav|aside)\b[^>]*>", r"<\1div>", r.html))) for r in pages]
    bare = [(i, u, re.sub(r' (class|id|role)="[^"]*"', "", x)) for i, u, x in bare]
    got = {r.page_id: r.text for r in h.main_texts(spark.createDataFrame(bare, "page_id long, url string, html string")).collect()}
    hit = found = total = 0
    for i, text_of in want.items():
        a, b = set(got[i].split("\n\n")), set(text_of.split("\n\n"))
        hit, found, total = hit + len(a & b), found + len(a), total + len(b)
    print("precision", hit / found, "recall", hit / total)
    assert hit / total > 0.95 and hit / found > 0.5


def site():
    """A host whose pages share a box and a list that no name gives away, one with few pages, and copies of one page."""
    box, links = "<div class=x1><p>Shared box</p></div>", "<ul><li>Home</li><li>About</li></ul>"
    rows = [(i, "http://www.a.example/p", f"<body>{links}<div><p>Story {i}</p><p>Same line</p></div>{box}</body>") for i in range(12)]
    rows += [(100 + i, "http://b.example", f"<body>{box}<p>Text {i}</p>") for i in range(3)]
    rows += [(200 + i, "http://c.example", "<body><div><p>Copied page</p></div></body>") for i in range(20)]
    rows += [(300 + i, "http://d.example", f"<article><p>License line</p><p>Own {i}</p></article>{box}") for i in range(9)]
    return [(i if i != 5 else None, u, x, "clash", 1) for i, u, x in rows] + [(900, None, None, None, None), (900, None, None, None, None)]


def test_templates_are_removed_per_host(spark):
    got = h.main_texts(spark.createDataFrame(site(), SCHEMA).repartition(3)).collect()
    by_id = {r.page_id: r.text for r in got if r.page_id != 900}
    assert len(got) == len(site()) and all(r.n_chars == len(r.text) for r in got)
    assert all(by_id[i] == f"Story {i}" for i in range(12) if i != 5) and by_id[None] == "Story 5"
    assert all(by_id[100 + i] == f"Shared box\n\nText {i}" for i in range(3))
    assert all(by_id[200 + i] == "Copied page" for i in range(20))
    assert all(by_id[300 + i] == f"License line\n\nOwn {i}" for i in range(9))
    assert [r.text for r in got if r.page_id == 900] == ["", ""]


def test_templates_match_brute_force(spark):
    rows = site()
    pages = {}
    for _, url, html, *_ in rows:
        pages.setdefault(urlsplit(url or "").hostname or "", {})[html or ""] = h.page(html).candidates()
    want = set()
    for name, found in pages.items():
        for x in set().union(*found.values()):
            n = sum(x in c for c in found.values())
            if n >= h.MIN_PAGES and 100 * n >= h.MIN_SHARE * len(found):
                want.add((name, x))
    got = h.templates(h.subtrees(spark.createDataFrame(rows, SCHEMA)), h.MIN_PAGES, h.MIN_SHARE).collect()
    assert {(r.host, r.subtree) for r in got} == want and want


@pytest.mark.parametrize("html", [
    "<div class=a>x</div><article class=b><div>y<b>z</div></article><div>w</div>", "<article>a</article><div>m</div><article>b</article>",
    "<div>x<article>never closed", "<ARTICLE>a</ARTICLE ><p>q", "no article <p>x</p>", "<section><article><p>a</article><ul><li>l</ul></section>",
])
def test_candidates_do_not_need_the_article(html):
    assert h.page(h.without_article(html)).candidates() == h.page(html).candidates()


def test_hosts_and_empty_table(spark):
    urls = [("http://A.b:80/x",), ("https://u:p@c.d?x",), ("nothing",), ("",), (None,)]
    df = spark.createDataFrame(urls, "url string").selectExpr("1L AS page_id", "url", "'' AS html")
    assert sorted(r.host for r in h.keyed(df).collect()) == ["", "", "", "a.b", "c.d"]
    assert h.main_texts(spark.createDataFrame([], SCHEMA).filter(F.lit(True))).collect() == []


@pytest.mark.parametrize("html,want", [
    ("<div class='content has-sidebar'><article><p>a</article></div>", "a"), ("<div class=widget><main><p>a</main></div>b", "a"),
    ("<article class='post tag-social'><p>a</article><p>b", "a"), ("<article class='post social'><p>a</article><p>b", "a"),
    ("<article><header class=entry-header><h1>t</h1></header><p>a", "t\n\na"), ("<article><h2 class=share>t</h2><p>a", "t\n\na"),
    ("<article><div class=section-header><h2>m</h2></div><p class=share-price>p</p><div id=related-work>w", "m\n\np\n\nw"),
    ("<form id=aspnet><article>a</article></form>", "a"), ("<div class=overlay><article>longer</article></div><article>b</article>", "longer\n\nb"),
    ("<div class=sidebar><article>t</article></div><article>longer</article>", "longer"),
    ("<article>a<div class=ad-container>x</div><div class='post__share'>y</div><ul class=social-links><li>z</ul></article>", "a"),
])
def test_names_delete_no_content(html, want):
    assert text(html) == want


def test_containers_that_recur_inside_articles_are_deleted(spark):
    box, teaser = "<div class=x1><p>More stories</p></div>", "<article><h2>Card</h2><p>Teaser</p></article>"
    rows = [(i, "http://a", f"<article><h1>T</h1><p>Shared</p><p>Own {i}</p>{box}<ul><li>tag</ul><section><article>Nested</article></section></article>{teaser}") for i in range(9)]
    rows += [(100 + i, "http://b", f"<article><h1>V {i}</h1><div><p>One story, many addresses</p></div></article>") for i in range(9)]
    rows += [(200 + i, "http://c", f"<p>{i}</p>{teaser}{teaser}") for i in range(9)]
    rows += [(300 + i, "http://d", f"<main><p>Own {i}</p>{box}</main>") for i in range(9)]
    rows += [(400 + i, "http://e", f"<article><p>Own {i}</p>{box}</article>") for i in range(4)]
    got = {r.page_id: r.text for r in h.main_texts(spark.createDataFrame([(*r, "", 1) for r in rows], SCHEMA).repartition(3)).collect()}
    assert all(got[i] == f"T\n\nShared\n\nOwn {i}" for i in range(9))
    assert all(got[100 + i] == f"V {i}\n\nOne story, many addresses" for i in range(9))
    assert all(got[200 + i] == "Card\n\nTeaser\n\nCard\n\nTeaser" for i in range(9))
    assert all(got[300 + i] == f"Own {i}" for i in range(9))
    assert all(got[400 + i] == f"Own {i}\n\nMore stories" for i in range(4))
