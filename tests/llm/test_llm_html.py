import re
from html import unescape

import pytest
from conftest import rows

from orderlens.llm.html_extract import best_container, extract, host_paths, parse, text_of

STORY = "A sentence that is long enough to be a paragraph of the story, with words."


def own_text(html):
    page = parse(html)
    return text_of(page, best_container(page))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>a<!-- c -->b</p><script>var t = '</p>';</script>", "ab"),
        (f"<article><h1>Title</h1><p>{STORY}<p>Next<br>line</article>", f"Title\n{STORY}\nNext line"),
        (f"<nav><a href=x>Menu</a></nav><div class='ad'>Buy</div><article><p>{STORY}</p></article><footer>c</footer>", STORY),
        (f"<body class='has-sidebar'><div id=cookie-notice>We use cookies</div><div class=post><p>{STORY}</p><div class=comments><p>Nice!</p></div></div>", STORY),
        (f"<header>Site</header><main><article><header><h1>T</h1></header><p>{STORY}</p><aside>see</aside></article></main>", f"T\n{STORY}"),
        (f"<div><h1>T</h1><div class=body><p>{STORY}</p><p>{STORY}</p><ul><li>one<li>two</ul></div></div>", f"T\n{STORY}\n{STORY}\none\ntwo"),
        (f"<article><p>{STORY} <a href='x>y'>link</a> 1 < 2 &copy;&#233;&nbsp;z</p><form>Search</form></article>", f"{STORY} link 1 < 2 ©é z"),
        (f"<article><p><b>{STORY}<p>two</i></p></article>", f"{STORY}\ntwo"),
        ("<div class='unclosed><p>x</p>", "x"),
        ("<article><p>We have <math><mi>x</mi><mo>=</mo><mn>1</mn></math> equal to <object data=y>one</object> here.</p></article>", "We have x=1 equal to one here."),
        ("<p>An <svg><text>no</text></svg>icon and <script>x()</script>a script.</p>", "An icon and a script."),
        ("<p>So <math><semantics><msup><mi>a</mi><mn>2</mn></msup><annotation encoding=t>a^2</annotation></semantics></math> is.</p>", "So a2 is."),
        ("<p>open", "open"),
    ],
)
def test_pages(html, text):
    assert own_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<article><header class='entry-header'><h1>T</h1></header><p>{STORY}</p></article>", f"T\n{STORY}"),
        (f"<article><h1 class=page-header>T</h1><div class='article-header'><p>By A.</p></div><p>{STORY}</p></article>", f"T\nBy A.\n{STORY}"),
        (f"<div class=header>Site</div><div id=content><div class=post-header><h1>T</h1></div><div class=text><p>{STORY}</p></div></div>", f"T\n{STORY}"),
        (f"<div id=post><h1 class=page-header>T</h1><p>{STORY}</p></div>", f"T\n{STORY}"),
        *((f"<article><p>{STORY}</p><div class='{mark}'><p>{STORY}</p></div></article>", f"{STORY}\n{STORY}") for mark in ("market-share", "notice", "related", "search", "skip-intro", "social", "widget-text")),
        (f"<div class=post><p>{STORY}</p><p>{STORY}</p><div class=notice><p>{STORY}</p></div></div>", "\n".join([STORY] * 3)),
        # still dropped: labels, links, other marks, and what stands outside
        (f"<article><p>{STORY}</p><div class=share>Share this</div><ul class=related><li><a href=x>{STORY}</a></ul></article>", STORY),
        (f"<article><div class=header><nav>Menu</nav></div><p>{STORY}</p><div class='social sidebar'><p>{STORY}</p></div></article>", STORY),
        (f"<div class=notice><p>{STORY}</p></div><div class=header><h1>Site</h1></div><article><p>{STORY} {STORY}</p></article>", f"{STORY} {STORY}"),
    ],
)
def test_marks_within_an_article(html, text):
    assert own_text(html) == text


def test_hosts_decide(spark):
    page = f"<div class='teaser-1'><p>%s</p></div><div class='story-7 x'><p>{STORY}</p><p>%s</p></div>"
    pages = [(i, f"http://Host.example/{i}", page % ("short", i)) for i in range(9)]
    # on this page alone, the teaser would win
    pages.append((9, "https://host.example:80/9?q", page % (STORY * 9, 9)))
    pages.append((10, "http://other.example/", page % (STORY * 9, 10)))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    assert dict(rows(host_paths(df)))["host.example"][0] == "/div.story-N.x"
    found = {r[0]: r[2] for r in rows(extract(df))}
    assert found[9] == f"{STORY}\n9"
    assert found[10] == STORY * 9


def extracted(spark, *pages):
    df = spark.createDataFrame([(i, f"http://h{h}.example/", p) for i, (h, p) in enumerate(pages)], "page_id bigint, url string, html string")
    found = {r[0]: r[2] for r in rows(extract(df))}
    return [found[i] for i in range(len(pages))]


def test_text_in_several_elements(spark):
    a, b, c = (f"{name} {STORY}" * 3 for name in "abc")
    parts = f"<div id=content>%s<div class=part><p>{a}</p></div><div class=part><p>{b} {c}</p></div></div><div class=footer>f</div>"
    other = f"<div class=lead><p>{a}</p></div><div class=rest><p>{b} {c}</p></div>"
    found = extracted(spark, (1, parts % ""), (2, parts % "<h1>T</h1>"), (3, f"<body><nav>n</nav><div>{other}</div></body>"))
    assert found == [f"{a}\n{b} {c}", f"T\n{a}\n{b} {c}", f"{a}\n{b} {c}"]


def test_all_elements_of_a_winning_path(spark):
    a, b = (f"{name} {STORY}" for name in "ab")
    page = "<div><div class=part><p>%s</p></div><div class=part><p>%s</p></div></div>"
    found = extracted(spark, *((1, page % (a * 20, i)) for i in range(5)), (1, page % (a, b)))
    assert found == [*(f"{a * 20}\n{i}" for i in range(5)), f"{a}\n{b}"]


def test_a_page_keeps_what_its_host_leaves_out(spark):
    a, b = (f"{name} {STORY}" for name in "ab")
    page = "<div id=content><div class=lead><p>%s</p></div><div class=rest><p>%s</p></div></div>"
    found = extracted(spark, *((1, page % (i, a * 20)) for i in range(5)), (1, page % (a, b)))
    assert found == [*([a * 20] * 5), f"{a}\n{b}"]


def test_several_articles(spark):
    a, b = (f"{name} {STORY}" for name in "ab")
    found = extracted(
        spark,
        (1, f"<main><article><p>{a}</p></article><nav>n</nav><article><p>{b}</p></article></main>"),
        (2, f"<div><article class=lead><p>{a}</p></article><aside>x</aside><article class=rest><p>{b}</p></article></div><footer>f</footer>"),
        (3, f"<article><p>{a}</p><article><p>{b}</p></article></article>"),
    )
    assert found == [f"{a}\n{b}"] * 3


def test_odd_pages(spark):
    pages = [(1, None, None), (1, None, None), (None, "", ""), (2, "no url", f"<article><p>{STORY}</p></article>"), (3, None, "<p>" + "long text " * 200_000)]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id bigint, url string, html string, host string, paths string")
    found = sorted(rows(extract(df)), key=repr)
    assert found == sorted(((i, u, t, len(t)) for (i, u, h), t in zip(pages, ["", "", "", STORY, ("long text " * 200_000).strip()], strict=True)), key=repr)


def test_no_pages(spark):
    assert rows(extract(spark.createDataFrame([], "page_id bigint, url string, html string"))) == []


def test_given_pages(spark):
    """The article of every page at the smallest scale, found by its tags."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r[0]: r[2] for r in rows(extract(pages))}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", row["html"], re.S)
        parts = re.split(r"</?(?:p|h1)>", article[1].replace("<br>", " "))
        blocks = (" ".join(unescape(re.sub(r"</?b>", "", p)).split()) for p in parts)
        assert found[row["page_id"]] == "\n".join(b for b in blocks if b)
