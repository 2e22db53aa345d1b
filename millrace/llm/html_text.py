"""Main text of web pages by composite text density.

A page is scanned once (forward only), and its elements put into a tree in which
elements that HTML closes by itself end where they should. What is never article is
left out first: menus, page headers, footers, sidebars, forms, scripts, styles, hidden
elements, and elements that their class, id or role names as advert, notice, comments
and the like.

For every other node the composite text density is taken: characters per tag,
adjusted for links,

    C / T * log(C / LC * T / LT) / log(1 + ln(C / (C - LC) * LC + LCb / Cb * C + e))

with C characters, T tags, LC and LT those of links, and b the body; a count of 0
divides as 1. The node whose children have the largest sum of densities is the centre
of the article. The least density on its path from the body is the threshold: beside
that path, blocks that reach it without being mostly links belong to the article, and
so do headings before the centre. If the centre lies in an article or main element
that holds a good part of the page's text, this is the article. Within it, nothing but
lists and boxes that are nearly all links is left out.

Text goes block by block: character references are decoded, white space in a block
becomes one space (a <br> is white space), blocks are joined by line ends in page order.

Defined results: null html is an empty page; a page without text gives an empty text;
what comes after the body's end still counts; a tag that the page ends in is dropped;
rows and their columns stay as they are (columns named text or n_chars give way).
A page takes some hundred bytes a tag and some times its size in one task.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.markup import RAW_TAGS, VOID_TAGS, attributes, scan

#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are no article.
NO_ARTICLE = frozenset("head title nav aside footer form script style noscript template button select textarea input iframe object svg canvas dialog menu search".split())
#: Roles of such elements.
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
#: Words in a class or id that name such elements.
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promotion popup modal overlay cookie cookies consent"
    " gdpr notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside rail footer header masthead topbar toolbar newsletter"
    " subscribe subscription signup login share sharing social related recommended recommendations comment comments reply replies respond disqus discussion"
    " widget pagination pager form search".split()
)
#: First words that turn such a name into a remark on something else.
REMARKS = frozenset("has with no without is not hide show".split())
#: What an element closes when it begins, and the elements beyond which it doesn't look.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
}
#: An open paragraph, or a closing tag, reaches out of none of these.
SCOPES = ("table", "caption", "td", "th", "button", "object")
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: An article or main element counts as the article if it holds this part of the page's text.
ARTICLE_PART = 0.25
#: A box with so many links, which hold this part of its text, is a menu.
MENU_LINKS, MENU_PART = 3, 0.9


class _Page:
    """The elements of a page in page order, and its texts with the element and the block run they are in."""

    def __init__(self, source: str):
        self.names, self.parents, self.marks = ["#page"], [-1], [""]
        self.texts: list[tuple[int, int, str]] = []
        self._opened, self._places, self._blocks, self._run = [0], {}, [], 0
        for kind, value, marks in scan(source, RAW_TAGS | {"textarea", "title", "xmp", "iframe", "noembed", "noframes"}):
            if kind == "text":
                raw = self.names[self._opened[-1]] in RAW_TAGS
                self.texts.append((self._opened[-1], self._run, value if raw else html.unescape(value)))
            elif kind == "close":
                self._close(value)
            else:
                self._open(value, marks, leaf=kind == "empty" and value not in BLOCKS)

    def _place(self, names) -> int:
        return max((p[-1] for n in names if (p := self._places.get(n))), default=-1)

    def _end(self, place: int) -> None:
        """Close what is open from a place on."""
        for node in reversed(self._opened[place:]):
            name = self.names[node]
            self._places[name].pop()
            if name in BLOCKS:
                self._blocks.pop()
                self._run += 1
        del self._opened[place:]

    def _open(self, name: str, marks: str, leaf: bool) -> None:
        if name in ("html", "body") and self._places.get(name):
            return
        if (head := self._place(("head",))) > 0 and name not in IN_HEAD:
            self._end(head)
        if name in BLOCKS:
            self._run += 1
            if (p := self._place(("p",))) > self._place(SCOPES):
                self._end(p)
        ends, within = CLOSES.get(name, ((), ()))
        if (other := self._place(ends)) > self._place(within):
            self._end(other)
        self.names.append(name)
        self.parents.append(self._opened[-1])
        self.marks.append(marks)
        if name == "br":
            self.texts.append((len(self.names) - 1, self._run, " "))
        if name in VOID_TAGS or leaf:
            return
        self._places.setdefault(name, []).append(len(self._opened))
        if name in BLOCKS:
            self._blocks.append(len(self._opened))
        self._opened.append(len(self.names) - 1)

    def _close(self, name: str) -> None:
        place = self._place((name,))
        if place < 0 or name in ("html", "body"):
            return
        if name not in BLOCKS and self._blocks and self._blocks[-1] > place:
            return  # an inline end closes no block
        if name not in ("table", "thead", "tbody", "tfoot", "tr") and place < self._place(SCOPES):
            return
        self._end(place)

    def no_article(self) -> list[bool]:
        """Which nodes are in something that is never article."""
        size = len(self.names)
        heads = [name in ("main", "h1") for name in self.names]
        for i in range(size - 1, 0, -1):
            heads[self.parents[i]] |= heads[i]
        inside, out = [False] * size, [False] * size
        for i in range(1, size):
            up, name = self.parents[i], self.names[i]
            inside[i] = inside[up] or name in ("article", "main")
            out[i] = out[up] or name in NO_ARTICLE or (name == "header" and not inside[up]) or (bool(self.marks[i]) and name not in ("html", "body", "main") and _named(attributes(self.marks[i]), inside[up] or name == "article", heads[i]))
        return out


def _named(marks: dict[str, str], in_article: bool, holds_heading: bool) -> bool:
    """Whether attributes say that an element is hidden or no article."""
    if "hidden" in marks or marks.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", marks.get("style", ""), re.I):
        return True
    if holds_heading:
        return False
    if marks.get("role", "").lower() in NO_ARTICLE_ROLES:
        return True
    for name in f"{marks.get('class', '')} {marks.get('id', '')}".split():
        words = re.findall(r"[a-z]+", f"{re.sub(r'(?<=[a-z])(?=[A-Z])', ' ', name)} {name}".lower())
        if words and words[0] not in REMARKS and any(w in NO_ARTICLE_WORDS and not (w == "header" and in_article) for w in words):
            return True
    return False


def _density(c: int, t: int, lc: int, lt: int, body: float) -> float:
    """Composite text density. body: link characters for each character of the body."""
    if not c:
        return 0.0
    gain = (c / max(1, lc)) * (max(1, t) / max(1, lt))
    base = math.log(c / max(1, c - lc) * lc + body * c + math.e)
    return c / max(1, t) * math.log(max(1.0, gain)) / math.log1p(base)


def main_text(source: str | None) -> str:
    """The article of a page."""
    page = _Page(source or "")
    names, parents, out = page.names, page.parents, page.no_article()
    size = len(names)
    chars, links, tags, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
    in_link = [False] * size
    for i in range(1, size):
        in_link[i] = in_link[parents[i]] or names[i] == "a"
        link_tags[i] = int(names[i] == "a")
    for node, _, text in page.texts:
        if not out[node]:
            n = len("".join(text.split()))
            chars[node] += n
            links[node] += n if in_link[node] else 0
    for i in range(size - 1, 0, -1):
        if not out[i]:
            up = parents[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i]
    body = next((i for i in range(size) if names[i] == "body"), 0)
    density = [0.0 if out[i] else _density(chars[i], tags[i], links[i], link_tags[i], links[body] / max(1, chars[body])) for i in range(size)]
    sums = [0.0] * size
    for i in range(1, size):
        sums[parents[i]] += density[i]
    inner = [i for i in range(size) if not out[i] and chars[i]]
    if not inner:
        return ""
    centre = max((i for i in inner), key=lambda i: (sums[i], -i))
    taken = _article(page, out, chars, links, density, centre, body)
    menu = [False] * size
    blocks: list[tuple[int, int, list[str]]] = []
    for i in range(1, size):
        boxed = names[i] in ("ul", "ol", "dl", "div", "section", "table") and link_tags[i] >= MENU_LINKS and links[i] >= MENU_PART * chars[i] and taken[parents[i]]
        menu[i] = menu[parents[i]] or (boxed and not out[i])
    near = [0] * size
    for i in range(1, size):
        near[i] = i if names[i] in BLOCKS else near[parents[i]]
    for node, run, text in page.texts:
        if taken[node] and not out[node] and not menu[node]:
            if not blocks or blocks[-1][:2] != (near[node], run):
                blocks.append((near[node], run, []))
            blocks[-1][2].append(text)
    return "\n".join(b for _, _, parts in blocks if (b := " ".join("".join(parts).split())))


def _article(page: _Page, out: list[bool], chars: list[int], links: list[int], density: list[float], centre: int, body: int) -> list[bool]:
    """Which nodes belong to the article around a centre."""
    names, parents, size = page.names, page.parents, len(page.names)
    path = [centre]
    while path[-1] > 0:
        path.append(parents[path[-1]])
    for kind in ("article", "main"):
        known = [i for i in path if names[i] == kind] or [i for i in range(size) if names[i] == kind and not out[i]]
        best = max(known, key=lambda i: (chars[i], -i), default=0) if not any(names[i] == kind for i in path) else known[0]
        if best and chars[best] >= ARTICLE_PART * chars[body]:
            taken = [False] * size
            for i in range(size):
                taken[i] = i == best or (i > 0 and taken[parents[i]])
            return taken
    on_path = set(path)
    threshold = min(density[i] for i in (path[: path.index(body) + 1] if body in on_path else path))
    taken = [False] * size
    for i in range(size):
        up = parents[i]
        beside = i > 0 and up in on_path and not taken[up] and i not in on_path
        dense = beside and names[i] in BLOCKS and density[i] >= threshold and 2 * links[i] < chars[i]
        heading = beside and i < centre and re.fullmatch("h[1-6]", names[i]) and (up not in (0, body) or names[i] == "h1")
        taken[i] = i == centre or (i > 0 and taken[up]) or bool(dense or heading)
    return taken


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def with_text(pages: DataFrame) -> DataFrame:
    """pages with the main text of their html and its length in code points."""
    pages = pages.drop(*(c for c in pages.columns if c.lower() in ("text", "n_chars")))
    return pages.withColumn("text", _main_text("html")).withColumn("n_chars", F.length("text").cast("long"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return with_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).drop("html")


#: For pages that mark their article as one element and its blocks as headings and paragraphs, as those of the given tables do.
SQL = r"""
WITH parts AS (
  SELECT page_id, url, unnest(list_transform(regexp_split_to_array(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '<br>', ' '), '</?(?:h1|p)>'),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(x, '</?[a-z][^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g')))) AS block,
    generate_subscripts(regexp_split_to_array(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '<br>', ' '), '</?(?:h1|p)>'), 1) AS i
  FROM pages
), texts AS (
  SELECT page_id, url, coalesce(string_agg(block, chr(10) ORDER BY i) FILTER (block <> ''), '') AS text FROM parts GROUP BY page_id, url
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""
