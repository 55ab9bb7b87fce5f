"""Main text of web pages by scoring the element tree.

Text holders (paragraphs and other elements that hold text of their own) pass points for length and
commas to their ancestors, half as many with each level; an element's points are discounted by the share
of its text that stands in links. The best container and those siblings that look like it are kept; where
it stands inside an article or main element, that element is the container. Elements that hold no article
text by their tag, role or name (menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts, styles) neither score nor appear. A name that only has such a word among others ("social-history")
decides for elements without running text alone; blocks of short links are menus, whatever their name.

A page is parsed with forgiving rules: paragraphs, list items and cells end where the next one starts,
end tags without a start are ignored, open elements end with their parent. Nulls and empty pages have an
empty text; a page of any length and depth is read whole, each element a fixed number of times. Of
containers with the same points the first is the best. No shuffle; repeated rows give repeated results, an
empty table an empty one, and a column that has the output's name already is an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Elements by the role they have in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
ENDS_BEFORE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
HOLDS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
    "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}, "optgroup": {"select"},
}
# What holds no article text, by tag, role and words of class or id.
NO_TEXT_TAGS = set(
    "head script style noscript template nav footer aside form button select option input textarea iframe svg canvas "
    "object embed audio video map dialog menu title noembed noframes xmp math".split()
)
NO_TEXT_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
NO_TEXT_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent disqus disclaimer footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
# Words that say so beside any other word, and words that say nothing.
ALWAYS = set(
    "ads adsense advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus disclaimer gdpr masthead nav navbar navigation newsletter pagination respond sidebar subscribe".split()
)
NEUTRAL = set(
    "area bar block bottom box button buttons container cta embed fixed form global group icons inline inner item items "
    "js left link links list module outer overlay page panel primary right row secondary section site slot sticky sub "
    "tools top unit widgets wrap wrapper".split()
)
ARTICLE_WORDS = set("article articlebody content entry main post story text body".split())
CONTAINERS = {"article", "main"}
PARAGRAPHS = {"p", "pre", "blockquote", "td", "th", "li", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption"}
WORD = re.compile(r"[a-z]+")
#: Characters outside links from which an element holds running text, and mean characters of a menu's links.
PROSE = 140
MENU_LINK = 30


class Element:
    __slots__ = ("tag", "attrs", "parent", "children", "score", "chars", "link_chars", "links", "within")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []
        self.score = 0.0
        self.chars = self.link_chars = self.links = 0
        self.within = parent is not None and (parent.within or parent.tag in CONTAINERS)

    def has_no_text(self) -> bool:
        """Whether it holds nothing of an article, by tag, role or name."""
        if self.tag in NO_TEXT_TAGS:
            return True
        if self.tag == "header":
            return not self.within
        if not self.attrs or self.tag in ("html", "body"):
            return False
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(self.attrs)}
        if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
            return True
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I):
            return True
        if given.get("role", "").lower() in NO_TEXT_ROLES:
            return True
        if self.tag in CONTAINERS:
            return False
        named = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{given.get('class', '')} {given.get('id', '')}").lower()
        words = set(WORD.findall(named))
        if words & ARTICLE_WORDS and not words & {"comment", "comments", "sidebar", "ad", "ads", "related"}:
            return False
        if words & ALWAYS:
            return True
        return bool(words & NO_TEXT_WORDS) and (words <= NO_TEXT_WORDS | NEUTRAL or not self.is_prose())

    def is_prose(self) -> bool:
        """Whether running text outweighs its links."""
        return self.chars - self.link_chars >= PROSE and link_density(self) < 0.3


def parse(page: str) -> list[Element]:
    """All elements, parents first, in page order."""
    root = Element("html", "", None)
    every, at, place, opened = [root], root, 0, Counter()

    def close(top: Element) -> Element:
        """Ends all open elements below `top`, which is open."""
        one = at
        while one is not top:
            opened[one.tag] -= 1
            one = one.parent
        return top

    for token in iter(lambda: TOKEN.search(page, place), None):
        start = token.start()
        if start > place:
            at.children.append(page[place:start])
        place = token.end()
        if token["data"] is not None:
            at.children.append(token["data"].replace("&", "&amp;"))
        if token["name"] is None:
            continue
        name = token["name"].lower()
        if token["end"]:
            if name == "br":
                every.append(Element("br", "", at))
                at.children.append(every[-1])
            elif opened[name] > 0:
                found = at
                while found.tag != name and not (name in INLINE and found.tag not in INLINE):
                    found = found.parent
                if found.tag == name:
                    at = close(found.parent)
            continue
        if name in ("html", "body"):
            continue
        if name not in INLINE:
            closing = ENDS_BEFORE.get(name)
            if closing or at.tag == "p" or at.tag in INLINE:
                found, stops, until = at, HOLDS.get(name, set()), at
                while found is not root and found.tag not in stops:
                    if found.tag == "p" or closing and found.tag in closing:
                        until = found.parent
                        if found.tag == name and name != "p":
                            break
                    elif not closing and found.tag not in INLINE:
                        break
                    found = found.parent
                at = close(until)
        own = Element(name, token["attrs"] or "", at)
        every.append(own)
        at.children.append(own)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, place)
            own.children.append(page[place : end.start() if end else len(page)])
            place = end.end() if end else len(page)
        elif name not in VOID and not (token["attrs"] or "").rstrip().endswith("/"):
            at = own
            opened[name] += 1
    if place < len(page):
        at.children.append(page[place:])
    return every


def walk(root: Element) -> Iterator[Element]:
    """Elements that may hold article text, parents first."""
    todo = [root]
    while todo:
        one = todo.pop()
        yield one
        todo += [c for c in reversed(one.children) if not isinstance(c, str) and not c.has_no_text()]


def text_of(one: Element, dropped: set[int]) -> str:
    """Text in page order: blocks apart, inline elements joined."""
    parts: list[str] = []
    todo: list[Element | str] = [one]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(unescape(item))
        elif id(item) not in dropped:
            if item.tag not in INLINE or item.tag in ("br", "img"):
                parts.append(" ")
                todo.append(" ")
            todo += reversed(item.children)
    return " ".join("".join(parts).split())


def measure(elements: list[Element]) -> None:
    """Characters of text, and of text in links, for each element with all below it."""
    for one in elements:
        one.chars = one.link_chars = one.links = 0
    for one in reversed(elements):
        if one.tag in NO_TEXT_TAGS:
            continue
        one.chars += sum(len(c.strip()) for c in one.children if isinstance(c, str))
        if one.tag == "a":
            one.link_chars, one.links = one.chars, 1
        if one.parent is not None:
            one.parent.chars += one.chars
            one.parent.link_chars += one.link_chars
            one.parent.links += one.links


def link_density(one: Element) -> float:
    return one.link_chars / one.chars if one.chars else 0.0


def score(elements: list[Element]) -> None:
    """Points of each text holder to its ancestors: all to the first, half as many to each next one."""
    for one in elements:
        own = "".join(
            c if isinstance(c, str) else "".join(x for x in c.children if isinstance(x, str))
            for c in one.children if isinstance(c, str) or c.tag in INLINE
        ).strip()
        if not own or one.tag in INLINE or not (one.tag in PARAGRAPHS or len(own) >= 25):
            continue
        points = (1 + own.count(",") + own.count("，") + min(len(own) / 100, 3.0)) * (1 - link_density(one))
        above = one.parent if one.tag in PARAGRAPHS else one
        if above is not None:
            above.score += points
    for one in reversed(elements):
        if one.parent is not None:
            one.parent.score += one.score / 2
    for one in elements:
        one.score *= 1 - link_density(one)


def is_menu(one: Element) -> bool:
    """A block of several short links."""
    return one.tag in ("ul", "ol", "div", "section", "table") and one.links > 2 and (
        link_density(one) > 0.6 and one.link_chars < MENU_LINK * one.links
    )


def containers(every: list[Element]) -> tuple[list[Element], set[int]]:
    """Kept elements in page order, and those inside them to leave out."""
    root = every[0]
    measure(every)
    elements = list(walk(root))
    measure(elements)
    score(elements)
    inside = {id(e) for e in elements}
    best = max(elements, key=lambda e: e.score)
    above = best
    while above is not None and above.tag not in CONTAINERS:
        above = above.parent
    best = above or best
    if best.score <= 0:
        best = next((e for e in elements if e.tag in CONTAINERS), root)
    kept = [best]
    if best.parent is not None:
        enough = max(10.0, 0.2 * best.score)
        kept = [
            s for s in best.parent.children if s is best or not isinstance(s, str) and id(s) in inside and (
                s.score >= enough or s.tag == "p" and s.chars > 80 and link_density(s) < 0.25
            )
        ]
    dropped = set()
    for top in kept:
        todo = [top]
        while todo:
            one = todo.pop()
            for child in one.children:
                if isinstance(child, str):
                    continue
                if id(child) not in inside or is_menu(child):
                    dropped.add(id(child))
                else:
                    todo.append(child)
    return kept, dropped


def main_text(page: str | None) -> str:
    if not page or not page.strip():
        return ""
    kept, dropped = containers(parse(page))
    return " ".join(t for t in (text_of(k, dropped) for k in kept) if t)


def extract(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """`pages` with the main text of `html` in `out`; all other columns pass through."""
    if out in pages.columns:
        raise ValueError(f"{out} is already a column")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [main_text(h.as_py()) for h in part.column(part.schema.get_field_index(html))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out]
                )

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())]))


def report(pages: DataFrame) -> DataFrame:
    """Per page: identifier, address, main text and its length."""
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
