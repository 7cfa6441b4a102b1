"""Main text of web pages: paragraphs pass points to their ancestors, the best container and its siblings stay."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADING = set("h1 h2 h3 h4 h5 h6".split())
#: Blocks that are paragraphs of their parent and never a container.
PARAGRAPH = HEADING | set("p pre li dt dd td th caption figcaption summary address".split())
#: Elements that hold no article text, by name, by role, and by a word of their class or id.
NEVER = RAW | set("nav aside footer form dialog head noscript template svg canvas audio video object button select input search menu".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NOISE = set(
    "ad ads adsense advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar masthead header footer sidebar aside widget widgets "
    "cookie cookies consent gdpr notice notices notification banner popup modal overlay newsletter subscribe subscription signup paywall "
    "comment comments commentlist disqus replies respond share sharing social related recommended".split()
)
#: A class that says what its page has or lacks, such as ``has-sidebar``, is no sidebar.
ABOUT = set("has with no without non show hide".split())
#: Start tags that end an open element of the first set, searched up to one of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "a": ({"a"}, BLOCK),
}
#: Share of links from which a list or container inside the article is a menu, and of the best score from which a sibling stays.
MENU, SIBLING = 0.8, 0.2

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]{0,65536}\"|'[^']{0,65536}')*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Za-z][a-z]*|[0-9]+")
_KEEP, _HEADINGS, _DROP = 0, 1, 2


def _names(value: str) -> bool:
    """Whether a class or id names an element that is not part of an article."""
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if words and not ABOUT.intersection(words) and (words[0] in NOISE or words[-1] in NOISE):
            return True
    return False


def _of_element(name: str, attributes: str, inside_article: bool) -> tuple[int, bool]:
    """What becomes of an element's text, and whether it is marked as the article."""
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    role = found.get("role", "").lower()
    marked = name in ("article", "main") or role == "main" or found.get("itemprop", "").lower() == "articlebody"
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return (_KEEP if name in ("html", "body") else _DROP), marked
    if name in NEVER or role in ROLES:
        return _DROP, marked
    named = f"{found.get('class', '')} {found.get('id', '')}"
    if name == "header" or (_names(named) and "header" in named.lower() and not marked):
        return (_HEADINGS if inside_article else _DROP), marked
    if name in ("html", "body") or (marked and "comment" not in named.lower()):
        return _KEEP, marked
    return (_DROP if named != " " and _names(named) else _KEEP), marked


class _Page:
    """The element tree of one page and the text blocks on it; elements are numbered in page order."""

    def __init__(self, html: str):
        self.parent, self.name, self.kind, self.fate, self.marked = [-1], ["#page"], [""], [_KEEP], [False]
        self.owner, self.text, self.size, self.linked = [], [], [], []  # of blocks
        self.links: list[int] = [0]  # links begun in an element
        self._stack, self._open = [0], Counter()
        self._parts, self._link_size = [], 0
        self._read(html)
        self._flush()

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                at = self._stack[-1]
                while self.name[at] not in BLOCK and at:
                    at = self.parent[at]
                self.owner.append(at)
                self.text.append(text)
                self.size.append(len(text))
                self.linked.append(min(self._link_size, len(text)))
            self._parts, self._link_size = [], 0

    def _pop_to(self, place: int) -> None:
        for at in self._stack[place:]:
            self._open[self.name[at]] -= 1
        del self._stack[place:]

    def _close(self, names: set[str], until: set[str]) -> None:
        """End the innermost open element of ``names`` that no element of ``until`` hides."""
        if any(self._open[n] for n in names):
            for place in range(len(self._stack) - 1, 0, -1):
                name = self.name[self._stack[place]]
                if name in names:
                    return self._pop_to(place)
                if name in until:
                    return None
        return None

    def _add(self, data: str) -> None:
        at = self._stack[-1]
        if data and (self.fate[at] == _KEEP or (self.fate[at] == _HEADINGS and any(self._open[h] for h in HEADING))):
            data = unescape(data) if "&" in data else data
            self._parts.append(data)
            if self._open["a"]:
                self._link_size += len(data.strip())

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._flush()
            self._close({"p"}, {"td", "th", "table", "caption"})
        if name in ENDS:
            self._close(*ENDS[name])
        if name == "br":
            self._parts.append(" ")
        if name in VOID:
            return
        above = self._stack[-1]
        fate, marked = _of_element(name, attributes, self._open["article"] + self._open["main"] > 0)
        self.parent.append(above)
        self.name.append(name)
        self.kind.append(attributes)
        self.fate.append(max(fate, self.fate[above]))
        self.marked.append(marked)
        self.links.append(int(name == "a"))
        self._stack.append(len(self.parent) - 1)
        self._open[name] += 1

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
            self._close({name}, {"td", "th"} - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") else set())
        else:
            self._close({name}, BLOCK)

    def _read(self, html: str) -> None:
        at = 0
        for token in iter(lambda: _TOKEN.search(html, at), None):
            self._add(html[at : token.start()])
            at = token.end()
            if token["name"]:
                name = token["name"].lower()
                if token["end"]:
                    self._end(name)
                    continue
                self._start(name, token["attributes"])
                if name in RAW:
                    ended = _RAW_END[name].search(html, at)
                    at = ended.start() if ended else len(html)
        self._add(html[at:])

    def best(self) -> str:
        """The blocks of the best container and its like siblings, one a line."""
        count = len(self.parent)
        score, size, linked, links, last = [0.0] * count, [0] * count, [0] * count, list(self.links), list(range(count))
        for owner, text, chars, link in zip(self.owner, self.text, self.size, self.linked):
            commas = sum(map(text.count, ",،、，"))
            points = (min(chars / 25, 1) + commas + min(chars / 100, 3)) * (1 - link / chars)
            score[self.parent[owner] if self.name[owner] in PARAGRAPH else owner] += points
            size[owner] += chars
            linked[owner] += link
        for at in range(count - 1, 0, -1):  # those below an element come after it
            above = self.parent[at]
            score[above] += score[at] / 2 if self.name[at] in BLOCK else score[at]
            size[above] += size[at]
            linked[above] += linked[at]
            links[above] += links[at]
            last[above] = max(last[above], last[at])

        def density(at: int) -> float:
            return linked[at] / size[at] if size[at] else 0.0

        def worth(at: int) -> float:
            return score[at] * (1 - density(at))

        if not self.owner:
            return ""
        containers = [at for at in range(count) if at == 0 or (self.name[at] in BLOCK and self.name[at] not in PARAGRAPH)]
        top = best = max(containers, key=lambda at: (worth(at), -at))
        while top and not self.marked[top]:
            top = self.parent[top]
        chosen, tag = (top, self.name[top]) if top else (best, None)
        least, kept = max(SIBLING * worth(best), 1e-9), {chosen}
        for at in (at for at in range(1, count) if self.parent[at] == self.parent[chosen] and at != chosen):
            if tag:  # an element marked as the article: only its like
                like = self.name[at] == tag and self.kind[at] == self.kind[chosen] and worth(at) >= least
            elif self.name[at] in PARAGRAPH:
                like = density(at) < 0.25 and (self.name[at] in HEADING or size[at] >= 80)
            else:
                like = self.name[at] in BLOCK and worth(at) >= max(least, 10)
            if like:
                kept.add(at)
        whole = bytearray(count)  # 1: kept, as its parent is
        for at in range(count):
            menu = links[at] > 1 and density(at) >= MENU and self.name[at] in ("ul", "ol", "dl", "div", "section", "table")
            whole[at] = at in kept or (at > 0 and whole[self.parent[at]] and not menu)
        return "\n".join(text for owner, text in zip(self.owner, self.text) if whole[owner])


def main_text(html: str | None) -> str:
    """The article of one page: its blocks, one a line."""
    return _Page(html).best() if html else ""


def with_main_text(df: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add ``into``, the article text of each page; rows stay where they are.

    A page is read as a whole, whatever its length, in time and memory
    proportional to it. Null and empty pages, and pages without text
    outside menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles and comments of readers, give an empty text; markup cut
    off at the end ends there. Of containers with equal scores the outermost
    and first wins. Equal pages have equal texts. An empty table gives no rows;
    of the other columns only one named ``into`` is replaced.
    """

    @F.pandas_udf("string")
    def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for page in pages:
            yield page.map(main_text, na_action=None)

    return df.withColumn(into, extract(F.coalesce(F.col(html), F.lit(""))))
