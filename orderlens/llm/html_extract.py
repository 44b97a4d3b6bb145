"""Main text of web pages by consensus of each host's pages.

Each page is parsed into blocks of text and the containers around them, its best container is
scored, and the container's path of tags and classes, with digits generalised, is the page's vote.
Spark counts the votes of each host; paths with at least ``SHARE`` of them (``PATHS`` at most by
that) win, and every page is extracted again from all elements with the most voted path it has. A page
that has none of its host's paths keeps its own container.

A container is narrowed only as long as ``KEPT`` of the page's text stays, so parts of a text that stand in
several elements keep the element around them; elements with the container's path are taken with it. Several
articles are taken together: those with one path, or all in the element around them.

Left out are elements whose tag, role, class or id marks them as menu, header, footer, sidebar, notice,
advert, form, script, style or reader comments. Within an article or the container that was found, headers stay,
and so do elements whose only marks are ``AMBIGUOUS`` words if they carry text: a block of ``LITTLE`` characters
without links, and links for less than half of it. Nothing else is dropped within a container. Formulas and embedded
objects are read as the words in them.

Unclosed and misnested tags are closed as browsers do for paragraphs, list items and table cells.
Defined results: null and empty pages give an empty text. Pages without a url share one host.
Repeated rows are extracted alike. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import kept_table, releasing

SHARE = 0.1
PATHS = int(1 / SHARE)
KEPT = 0.85  # a container gives way to a child with so much of the page's text
TITLE_ROOM = 0.3  # a parent with a title may add so much text

LITTLE = 40  # characters of a block, at least, that tell text from labels

# HTML's element names by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea select annotation annotation-xml".split())
CONTAINERS = frozenset("html body div section article main td center".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var object math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded "
    "mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
HEADINGS = frozenset("h1 h2".split())
DROPPED = frozenset("head nav footer aside form button dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments consent "
    "cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup promo promotion recommended related replies respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
AMBIGUOUS = frozenset("notice related search share sharing skip social widget widgets".split())  # marks that parts of an article may bear
CLOSES = {  # a start tag ends an open element of these kinds first
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
    "option": frozenset(("option",)), "body": frozenset(("head",)),
}
SCOPES = frozenset("ul ol dl table body html".split())  # an end by a start tag reaches no further

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    parent: int
    path: str
    dropped: bool
    container: int  # the nearest container, itself included
    text: float = 0.0  # of its own blocks, without links
    below: float = 0.0  # of its whole subtree
    title: bool = False
    mark: str = ""  # the weak mark of its own: "header" or "ambiguous"
    marked: bool = False  # another mark of its own


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # element, text; in page order
    linked: list[int] = field(default_factory=list)  # characters in links of each block


def _marks(tag: str, attributes: dict[str, str]) -> tuple[str, bool]:
    """What marks an element as no part of an article: its weak mark, and whether it has another."""
    if tag in DROPPED or attributes.get("role", "").lower() in ROLES:
        return "", True
    weak = "header" if tag == "header" else ""
    if tag in ("html", "body", "main", "article") or not attributes:
        return weak, False
    words = {w.lower() for name in ("class", "id") for w in PARTS.findall(attributes.get(name, ""))} & MARKS
    if words - AMBIGUOUS - {"header"}:
        return weak, True
    return "ambiguous" if words & AMBIGUOUS else "header" if words else weak, False


def _carrying(page: Page) -> list[bool]:
    """Whether each element carries text: see AMBIGUOUS in the module's description."""
    elements = page.elements
    total, linked, block = ([0] * len(elements) for _ in range(3))
    for (owner, text), links in zip(page.blocks, page.linked, strict=True):
        total[owner] += len(text)
        linked[owner] += links
        block[owner] = max(block[owner], len(text) - links)
    for n in range(len(elements) - 1, 0, -1):
        if not elements[n].marked:
            up = elements[n].parent
            total[up] += total[n]
            linked[up] += linked[n]
            block[up] = max(block[up], block[n])
    return [b >= LITTLE and 2 * k < t for t, k, b in zip(total, linked, block, strict=True)]


def judge(page: Page, scopes: set[int]) -> list[bool]:
    """Whether each element is dropped; headers, and ambiguous elements that carry text, stay within the scopes."""
    elements = page.elements
    carrying = _carrying(page) if any(e.mark == "ambiguous" for e in elements) else []
    within, dropped = [False] * len(elements), [False] * len(elements)
    for n, e in enumerate(elements):
        if n:
            within[n], dropped[n] = within[e.parent], dropped[e.parent]
        stays = within[n] and (e.mark == "header" or e.mark == "ambiguous" and carrying[n])
        dropped[n] |= e.marked or bool(e.mark) and not stays
        within[n] |= n in scopes
    return dropped


def parse(html: str) -> Page:
    page = Page([Element("", -1, "", False, 0)])
    elements, stack = page.elements, [0]
    pieces: list[str] = []
    linked = at = 0
    size, end = len(html), len(html)

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(unescape(text))
            if any(elements[e].tag == "a" for e in stack[-4:]):
                linked += len(text)

    def close_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                owner = next(e for e in reversed(stack) if elements[e].tag not in INLINE)
                page.blocks.append((owner, text))
                page.linked.append(min(len(text), linked))
        linked = 0

    while at < size:
        match = MARKUP.search(html, at, end)
        if not match:
            add(html[at:])
            break
        add(html[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if not tag:
            continue
        tag, closing = tag.lower(), bool(match[1] or match[4])
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in INLINE and tag not in RAW:
            close_block()
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if elements[stack[i]].tag == tag), 0)
            if depth:
                if tag in INLINE:
                    # a misnested inline tag ends no block around it
                    if all(elements[e].tag in INLINE for e in stack[depth:]):
                        del stack[depth:]
                else:
                    del stack[depth:]
            continue
        if tag in VOID:
            continue
        given = match[3] if match[2] else match[6]
        if tag in RAW and not given.endswith("/"):
            ended = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = ended.end() if ended else size
            continue
        if tag not in INLINE:
            # a block ends an open paragraph; items and cells end their kind
            ends = CLOSES.get(tag, frozenset())
            for i in range(len(stack) - 1, 0, -1):
                name = elements[stack[i]].tag
                if name in ends or name == "p":
                    del stack[i:]
                elif name in SCOPES or name in CONTAINERS:
                    break
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(given)} if "=" in given else {}
        parent = stack[-1]
        above = elements[parent]
        name = tag
        if attributes.get("class"):
            name += "." + ".".join(sorted(re.sub(r"\d+", "N", c) for c in set(attributes["class"].split())))
        path = above.path if tag in ("html", "body") else f"{above.path}/{name}"
        number = len(elements)
        is_box = tag in CONTAINERS
        mark, marked = _marks(tag, attributes)
        elements.append(Element(tag, parent, path, False, number if is_box else above.container, mark=mark, marked=marked))
        if not given.endswith("/") or tag in CONTAINERS:
            stack.append(number)
    close_block()
    dropped = judge(page, {n for n, e in enumerate(elements) if e.tag in ("article", "main")})
    for element, out in zip(elements, dropped, strict=True):
        element.dropped = out
    for (owner, text), links in zip(page.blocks, page.linked, strict=True):
        box = elements[owner].container
        if not dropped[owner]:
            elements[box].text += len(text) - links
        if elements[owner].tag in HEADINGS:
            # a heading in a header, or marked as one, is the title of what stands around
            n = owner
            while elements[n].mark == "header" or n not in (0, box) and not (elements[n].mark or elements[n].marked):
                n = elements[n].parent
                box = elements[n].container
            elements[box].title |= not elements[n].dropped
    for element in reversed(elements):
        element.below += element.text
        if element.parent >= 0:
            elements[element.parent].below += element.below
    return page


def alike(page: Page, container: int) -> list[int]:
    """The undropped elements with the path of a container, itself included."""
    path = page.elements[container].path
    found = [n for n, e in enumerate(page.elements) if e.path == path and e.container == n and not e.dropped and e.below > 0]
    return found if container in found else [container]


def around(page: Page, articles: list[int]) -> int:
    """The largest article if those with its path hold most of their text, or else the nearest container of all."""
    elements = page.elements
    above = []
    for n in articles:
        line = [n]
        while elements[line[-1]].parent >= 0:
            line.append(elements[line[-1]].parent)
        above.append(line)
    given = set(articles)
    outer = [line for line in above if not given & set(line[1:])]  # others stand within these
    largest = max((line[0] for line in outer), key=lambda n: elements[n].below)
    total = sum(elements[line[0]].below for line in outer)
    same = sum(elements[line[0]].below for line in outer if elements[line[0]].path == elements[largest].path)
    if same >= KEPT * total:
        return largest
    shared = set(outer[0]).intersection(*outer[1:])
    return next(n for n in outer[0] if n in shared and elements[n].container == n)


def best_container(page: Page) -> int:
    """The container that holds most of the text and little else; an article is taken whole."""
    elements = page.elements
    children: dict[int, list[int]] = {}
    for number, element in enumerate(elements):
        if element.container == number and number:
            parent = elements[element.parent].container
            children.setdefault(parent, []).append(number)
    articles = [n for n, e in enumerate(elements) if e.tag == "article" and not e.dropped and e.below > 0]
    if articles:
        return around(page, articles)
    at = 0
    while True:
        inner = max(children.get(at, ()), key=lambda n: elements[n].below, default=None)
        if inner is None or elements[inner].below < KEPT * elements[0].below or not elements[at].below:
            break
        at = inner
    while at and elements[at].parent > 0:
        up = elements[elements[at].parent].container
        if elements[up].tag in ("", "html", "body") or not elements[up].title:
            break
        if elements[up].below > (1 + TITLE_ROOM) * elements[at].below:
            break
        at = up
    return at


def text_of(page: Page, *containers: int) -> str:
    """The blocks of containers in page order."""
    elements = page.elements
    scopes = {n for n in containers if elements[n].tag not in ("", "html", "body")}
    dropped = judge(page, scopes | {n for n, e in enumerate(elements) if e.tag in ("article", "main")})
    inside = [False] * len(elements)
    for number, element in enumerate(elements):
        inside[number] = number in containers or element.parent >= 0 and inside[element.parent]
    return "\n".join(text for owner, text in page.blocks if inside[owner] and not dropped[owner])


def chosen_containers(page: Page, paths: list[str]) -> list[int]:
    """The elements with the first winning path that the page has, or else with the path of its own best.

    The page's own best also stays where the winning path would leave out more of it than ``KEPT`` allows, unless it is
    the whole body, where what stands beside is mostly the site's.
    """
    elements = page.elements
    own = best_container(page)
    for path in paths:
        found = next((n for n, e in enumerate(elements) if e.path == path and e.container == n and not e.dropped and e.below > 0), None)
        if found is not None:
            chosen = alike(page, found)
            within = [n for n in chosen if elements[n].path.startswith(f"{elements[own].path}/")]
            whole = sum(elements[n].below for n in within) >= KEPT * elements[own].below
            return chosen if not within or whole or elements[own].tag in ("", "html", "body") else alike(page, own)
    return alike(page, own)


def host(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, weights = [], []
        for html in batch.column("html").to_pylist():
            page = parse(html or "")
            best = best_container(page)
            paths.append(page.elements[best].path)
            weights.append(sum(page.elements[n].below for n in alike(page, best)))
        columns = [batch.column("host"), pa.array(paths, pa.string()), pa.array(weights, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "weight"])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): winning paths, most votes first; pages without text do not vote."""
    given = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    votes = given.mapInArrow(releasing(_votes), "host string, path string, weight double").where("weight > 0")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("weight").alias("weight"))
    counted = kept_table(counted, "votes")
    totals = counted.groupBy("host").agg(F.sum("votes").alias("total"))
    # at most PATHS rows of a host pass the filter, so the lists are short
    won = counted.join(totals, "host").where(F.col("votes") >= SHARE * F.col("total"))
    lists = won.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("votes", "weight", "path")), asc=False).alias("best")
    )
    return lists.select("host", F.col("best.path").alias("paths"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True):
            page = parse(html or "")
            texts.append(text_of(page, *chosen_containers(page, paths or [])))
        columns = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: id, url, text, n_chars."""
    winners = kept_table(host_paths(pages, url_col, html_col), "host-paths")
    given = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("host")
    )
    kind = given.schema["id"].dataType.simpleString()
    found = given.join(winners, "host", "left").select("id", "url", "html", "paths")
    found = found.mapInArrow(releasing(_texts), f"id {kind}, url string, text string")
    return found.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars")
    )
