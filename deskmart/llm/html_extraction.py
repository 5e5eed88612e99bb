"""Main text of web pages by consensus of a host's pages.

Each page's containers are scored by the running text they hold outside links and outside parts that are marked
as menus, adverts and the like. A page votes for the generalised path of its best container: the tags and classes from
the root, with digits blurred. Votes are summed per host and path in Spark, next to the pages on which the path holds any text, and the pages are
read again. A path that its host's pages often have but seldom vote for is boilerplate: where it is a page's best, the page yields the
text of the path that usually wins there instead. A short article in a page full of unmarked boilerplate is thus found by the
company it keeps, while a page of another template keeps its own container.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import small, stage

HOST_ROWS = 50_000  # broadcast at most
SHARE = 0.01  # of a host's weight, so that at most a hundred times the paths of a page are kept
USUAL = 0.5  # a path that wins less often where it stands is boilerplate

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Their content is not markup and never text of a page.
_RAW = frozenset("script style noscript template iframe object svg canvas title textarea select audio video".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder".split()
)
_EMPTY = frozenset("img wbr br hr input meta link area base col embed param source track".split())
# Elements that open a container; other block elements only end a block.
_CONTAINER = frozenset(
    "html body div article section main aside nav header footer ul ol dl table tbody thead tfoot tr td th form fieldset figure "
    "blockquote center details dialog menu button address hgroup search".split()
)
_OUT_TAGS = frozenset("nav aside footer form fieldset button dialog menu search head".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disclaimer discussion disqus footer footnav form gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promotion recommend recommendations recommended related reply "
    "respond responses search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription toc toolbar topbar "
    "tracking widget widgets alert announcement aside teaser teasers".split()
)
_LAYOUT = frozenset("with has no without layout wrapper page site container".split())
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[^A-Za-z]+")


def _names(value: str) -> list[str]:
    return value.lower().split()


def _words(name: str) -> set[str]:
    return set(_WORDS.split(re.sub(r"([a-z])([A-Z])", r"\1-\2", name))) - {""}


def _is_out(tag: str, attributes: dict[str, str], within_article: bool) -> bool:
    """Whether an element is marked as something else than the article.

    One word of a class is enough for a container; of articles and of elements inside a block, all words of a class must say so.
    """
    if tag in _OUT_TAGS or (tag == "header" and not within_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in _OUT_ROLES or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    if tag in ("html", "body", "main"):
        return False
    sure = tag not in _CONTAINER or tag == "article"
    for name in [*_names(attributes.get("class", "")), *_names(attributes.get("id", ""))]:
        words = _words(name)
        if words <= _OUT_WORDS if sure and not (tag == "article" and within_article) else words & _OUT_WORDS and not words & _LAYOUT:
            if words:
                return True
    return False


class Scanner:
    """Tags of a page from left to right, in time linear in the page.

    What is known to be missing in the rest of the page is not looked for again, and places from which no tag can end are remembered.
    """

    def __init__(self, html: str):
        self.html = html
        self._missing: set[str] = set()
        self._dead: set[int] = set()
        self._special = (0, -1)  # from, place: the next quote or bracket from anywhere between

    def find(self, text: str, at: int) -> int:
        if text in self._missing:
            return -1
        found = self.html.find(text, at)
        if found < 0:
            self._missing.add(text)
        return found

    def _next_special(self, at: int) -> int:
        if not self._special[0] <= at <= self._special[1]:
            m = None if "special" in self._missing else _SPECIAL.search(self.html, at)
            if m is None:
                self._missing.add("special")
                return -1
            self._special = (at, m.start())
        return self._special[1]

    def tag_end(self, at: int) -> int:
        """Place of the bracket that ends the tag around ``at``, outside quotes if these are closed; -1 if there is none."""
        path, start = [], at
        while True:
            place = self._next_special(at)
            if place < 0 or place in self._dead:
                break
            if self.html[place] == ">":
                return place
            path.append(place)
            closed = self.find(self.html[place], place + 1)
            if closed < 0:
                break
            at = closed + 1
        self._dead.update(path)
        return self.find(">", start)


@dataclass
class Page:
    """Containers of a page (parent, path, out) and its text in pieces (container, text, inside a link, inside something marked)."""

    parents: list[int] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    out: list[bool] = field(default_factory=list)
    semantic: list[bool] = field(default_factory=list)
    pieces: list[tuple[int, str, bool, bool]] = field(default_factory=list)


def parse(html: str | None) -> Page:
    """Read tolerant of unclosed and stray tags; markup that never ends is text."""
    page, html = Page([-1], [""], [False], [False], []), html or ""
    scan, stack = Scanner(html), [("", 0)]
    link, at, begin = 0, 0, 0
    marked, nested, depth = "", 0, 0  # an element inside a block that is out, how often its tag is open, and in how many containers it stands

    def text(end: int) -> None:
        if end > begin:
            page.pieces.append((stack[-1][1], html[begin:end], link > 0, marked != ""))

    while (at := scan.find("<", at)) >= 0:
        if html.startswith("<!--", at):
            text(at)
            end = scan.find("-->", at + 4)
            begin = at = len(html) if end < 0 else end + 3
            continue
        if html.startswith("<![CDATA[", at) and (end := scan.find("]]>", at)) >= 0:
            text(at)
            begin = at = end + 3
            continue
        if html.startswith(("<!", "<?"), at) and (end := scan.find(">", at)) >= 0:
            text(at)
            begin = at = end + 1
            continue
        m = _NAME.match(html, at)
        end = scan.tag_end(m.end()) if m else -1
        if end < 0:
            at += 1
            continue
        text(at)
        tag, closing, inside = m[1].lower(), html[at + 1] == "/", html[m.end() : end]
        begin = at = end + 1
        alone = inside.endswith("/")
        if tag in _RAW and not closing:
            if not alone:
                closed = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                end = scan.find(">", closed.start()) if closed else -1
                begin = at = len(html) if end < 0 else end + 1
            page.pieces.append((stack[-1][1], " ", False, False))
            continue
        inline = tag in _INLINE
        if marked and (tag == marked and tag not in _EMPTY or not inline):
            if tag == marked and not closing and inline:
                nested += 1
            elif tag == marked and closing and nested > 1:
                nested -= 1
            elif tag == marked or marked in _INLINE or marked in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or len(stack) < depth:
                marked = ""
        if tag == "a":
            link = 0 if closing else 1
        if inline and (closing or not inside or alone):
            continue
        if not inline:
            page.pieces.append((stack[-1][1], " ", False, False))  # the end of a block
            link = 0
        attributes = {}
        if not closing and not alone and inside.strip():
            attributes = {a.lower(): entities.unescape(x or y or z or "") for a, x, y, z in _ATTRIBUTE.findall(inside)}
        if tag not in _CONTAINER:
            if attributes and not marked and tag not in _EMPTY and _is_out(tag, attributes, page.semantic[stack[-1][1]]):
                marked, nested, depth = tag, 1, len(stack)
        elif closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            if marked and len(stack) < depth:
                marked = ""
        elif not alone:
            node = stack[-1][1]
            classes = sorted({_DIGITS.sub("#", c) for c in _names(attributes.get("class", ""))})
            page.parents.append(node)
            page.paths.append(page.paths[node] + "/" + ".".join([tag, *classes]))
            page.out.append(page.out[node] or marked != "" or _is_out(tag, attributes, page.semantic[node]))
            main = tag in ("article", "main") or attributes.get("role", "").lower() == "main"
            page.semantic.append(page.semantic[node] or main or attributes.get("itemprop", "").lower() == "articlebody")
            stack.append((tag, len(page.parents) - 1))
    text(len(html))
    return page


def scores(page: Page) -> list[float]:
    """Text that counts, below each container.

    Text counts once, three times inside an element that says it is the article, and not at all in links and in parts marked as
    something else.
    """
    held = [0.0] * len(page.parents)
    for node, text, link, marked in page.pieces:
        if not (link or marked or page.out[node]):
            held[node] += len(text.strip()) * (3 if page.semantic[node] else 1)
    for node in range(len(held) - 1, 0, -1):
        held[page.parents[node]] += held[node]
    return held


def best_path(page: Page, held: list[float]) -> tuple[str, float]:
    """Path of the container to vote for, and the weight of the page; an empty path if the page has no text.

    The best container is the deepest that holds at least four fifths of all that counts.
    """
    total = held[0]
    if total <= 0:
        return "", 0.0
    best = 0
    for node in range(1, len(held)):  # parents come before their children
        if held[node] >= 0.8 * total and page.parents[node] == best:
            best = node
    return page.paths[best], total / (total + 200)


def text_at(page: Page, path: str | None) -> str | None:
    """Text of the containers at ``path``; None if the page has none."""
    inside = [False] * len(page.parents)
    for node, own in enumerate(page.paths):
        inside[node] = (own == path and not page.out[node]) or (node > 0 and inside[page.parents[node]])
    if not any(inside):
        return None
    text = "".join(t for node, t, _, marked in page.pieces if inside[node] and not marked and not page.out[node])
    return " ".join(entities.unescape(text).split())


def main_text(html: str | None, known: dict[str, float]) -> str:
    """Text of the page's best container, or, if its path seldom wins where it stands, of the path that usually does.

    ``known`` has the paths that a fair share of the host's pages have: how often they win there. Of several that usually
    win the one with most of the page's text counts; a page without any text in them keeps its own.
    """
    page = parse(html)
    held = scores(page)
    path = best_path(page, held)[0]
    if known.get(path, 1.0) < USUAL:
        text: dict[str, float] = {}
        for node, other in enumerate(page.paths):
            if known.get(other, 0.0) >= USUAL and held[node] > 0:
                text[other] = text.get(other, 0.0) + held[node]
        if text:
            path = min(text, key=lambda p: (-text[p], p))
    return text_at(page, path) or ""


def host_of(url):
    """Host of a URL in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def known_paths(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """``host, known``: of each host of ``pages(url, html)``, the paths that some page votes for and that hold text in pages with at least ``share`` of the
    host's weight, with the part of that weight that votes for them. Pages without a host do not vote."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, html in zip(batch["host"], batch["html"], strict=True):
                page = parse(html)
                held = scores(page)
                best, weight = best_path(page, held)
                rows.append((host, "", 0.0, weight))  # the host itself
                for path in {p for p, h in zip(page.paths, held, strict=True) if h > 0 and p}:
                    rows.append((host, path, weight if path == best else 0.0, weight))
            own = pd.DataFrame(rows, columns=["host", "path", "won", "had"])
            yield own.groupby(["host", "path"], as_index=False)[["won", "had"]].sum()

    hosted = pages.select(host_of(pages["url"]).alias("host"), "html").filter("host <> ''")
    votes = hosted.mapInPandas(vote, "host string, path string, won double, had double")
    summed = stage(votes.groupBy("host", "path").agg(F.sum("won").alias("won"), F.sum("had").alias("had")).filter("won > 0 or path = ''"), "host-votes")
    whole = summed.filter("path = ''").select(F.col("host").alias("_host"), F.col("had").alias("all"))
    often = summed.filter("path <> ''").join(whole, F.col("host") == F.col("_host")).filter(F.col("had") >= share * F.col("all"))
    one = F.struct("path", F.round(F.col("won") / F.col("had"), 6).alias("wins"))
    return stage(often.groupBy("host").agg(F.array_sort(F.collect_list(one)).alias("known")), "host-paths")


def extract_main_text(pages: DataFrame, host_rows: int = HOST_ROWS) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``.

    A NULL or empty html, and a page without text, has an empty text. Pages without a host in their url stand each for itself.
    Repeated rows give repeated rows; ties between paths go to the first in order; an empty table gives no rows; further columns are ignored.
    """
    paths = small(known_paths(pages), host_rows).withColumnRenamed("host", "_host")
    own = pages.select("page_id", "url", "html", host_of(pages["url"]).alias("_at"))
    with_paths = own.join(paths, F.col("_at") == F.col("_host"), "left").select("page_id", "url", "html", "known")

    @F.pandas_udf("string")
    def text(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, known in parts:
            tables = ({} if k is None else {x["path"]: x["wins"] for x in k} for k in known)
            yield pd.Series([main_text(h, k) for h, k in zip(html, tables, strict=True)], dtype=object)

    found = with_paths.select("page_id", "url", text("html", "known").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
