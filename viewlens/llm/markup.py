"""Reads one HTML page into containers and blocks of text, in time linear in its length.

Elements that are never part of an article are left out while reading: menus, page
headers, footers, sidebars, forms, scripts, hidden parts, and those whose class, id
or role says that they hold adverts, notices, shares or reader comments.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements and names of the markup language and its usual vocabulary.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes", "xmp", "template"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
CONTAINERS = {"section", "article", "main", "div", "center", "td", "th"}
BLOCKS = CONTAINERS | {
    "address", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "dir", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "html", "legend", "li", "listing", "menu", "nav", "ol", "optgroup",
    "option", "p", "pre", "search", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An element that closes an open one of these, unless one of the others lies between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tr", "tbody", "thead", "tfoot"}, {"table"}),
}
LEFT_OUT = {
    "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "input", "label",
    "map", "menu", "meter", "nav", "object", "output", "picture", "progress", "search", "select",
    "svg", "video",
}
LEFT_OUT_ROLES = {
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu",
    "menubar", "navigation", "search", "status", "toolbar",
}
MAIN_TAGS = {"article", "main"}
#: Words of a class or id: those that always count, and those that do not where
#: the element is an article or main element, or holds one.
ALWAYS_WORDS = {
    "ad", "ads", "advert", "advertisement", "adverts", "comment", "comments", "disqus", "promo",
    "related", "replies", "reply", "sponsor", "sponsored", "teaser",
}
LEFT_OUT_WORDS = {
    "adsense", "alert", "banner", "breadcrumb", "breadcrumbs", "consent", "cookie", "cookies",
    "copyright", "disclaimer", "discussion", "footer", "gdpr", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "outbrain", "pager", "pagination", "popup", "recommended", "respond", "share", "sharing",
    "sidebar", "signup", "sitemap", "skip", "social", "subscribe", "taboola", "toolbar", "topbar",
    "widget",
}
#: A class that begins or ends so tells what an element goes with, not what it is.
STATES = {"active", "closed", "disabled", "enabled", "off", "on", "open"}
ABOUT = {
    "cat", "category", "format", "has", "hide", "is", "lang", "no", "not", "page", "show", "status",
    "tag", "theme", "type", "with", "without",
}

TAG = re.compile(
    r"<(/?)([a-zA-Z][^\t\n\f\r />]*+)"
    r"((?:=[\t\n\f\r ]*+(?:\"[^\"]*+\"|'[^']*+'|[^\t\n\f\r \"'>][^\t\n\f\r >]*+|(?=>))|[^=>]++)*+)>"
)
OPENING = re.compile(r"</?[a-zA-Z]")
COMMENT_END = re.compile(r"--!?>")
ATTRIBUTE = re.compile(
    r"([^\t\n\f\r /=]++)(?:[\t\n\f\r ]*+=[\t\n\f\r ]*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\t\n\f\r ]*+)))?+"
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
CLOSING = {name: re.compile(rf"</{name}(?=[\t\n\f\r />])", re.I) for name in RAW}
#: Containers nested deeper count as part of the last one within it.
DEPTH = 24
#: Characters of a step; longer names are told apart by these alone.
STEP = 60
#: Open elements looked at for one that a start tag closes.
LOOK_BACK = 64


@dataclass
class Page:
    """Containers in page order, the first being the page; and blocks of text.

    ``parents`` and ``paths`` belong to containers, ``blocks`` are (container, text,
    characters in links, is a heading).
    """

    parents: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    blocks: list[tuple[int, str, int, bool]] = field(default_factory=list)


def read_page(text: str | None) -> Page:
    """Null reads as empty. What follows a tag or comment that never ends is not text."""
    return _Reader(text or "").page


def step(tag: str, attributes: dict[str, str]) -> str:
    """One step of a path: the tag and its classes, else its id, with digits made alike."""
    names = attributes.get("class", "").split() or attributes.get("id", "").split()[:1]
    plain = sorted({re.sub(r"\d+", "0", n) for n in names})
    return ".".join([tag, *plain])[:STEP]


def named(words: set[str], attributes: dict[str, str]) -> bool:
    """Whether a class or the id of an element holds one of the words."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [w.lower() for w in WORD.findall(name)]
        about = not parts or parts[0] in ABOUT or parts[-1] in STATES
        if not about and not words.isdisjoint(parts):
            return True
    return False


def left_out_always(tag: str, attributes: dict[str, str]) -> bool:
    style = attributes.get("style", "").replace(" ", "").lower()
    return (
        tag in LEFT_OUT
        or named(ALWAYS_WORDS, attributes)
        or attributes.get("role", "").strip().lower() in LEFT_OUT_ROLES
        or "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    )


class _Reader:
    """One pass over a page.

    Open elements are (tag, container, left out). Left out is 2 within an element
    that never counts, 1 within one left out by name, which counts again where
    it turns out to hold an article; 3 within a header, where only headings count.
    """

    def __init__(self, source: str):
        self.page = Page(parents=[-1], tags=["html"], paths=["html"])
        self.depths = [0]
        self.named: list[int] = [0]  # for each container the name-marked region it lies in
        self.regions: list[tuple[int, bool]] = [(-1, True)]  # parent region, holds an article
        self.regions_of_blocks: list[int] = []
        self.open: list[tuple[str, int, int, int]] = []  # tag, container, left out, region
        self.count: dict[str, int] = {}
        self.container, self.left_out, self.region = 0, 0, 0
        self.parts: list[str] = []
        self.linked, self.in_link, self.heading = 0, False, False
        self.read(source)
        self.flush()
        kept = [self.counts(r) for r in range(len(self.regions))]
        pairs = zip(self.page.blocks, self.regions_of_blocks, strict=True)
        self.page.blocks = [block for block, region in pairs if kept[region]]

    def counts(self, region: int) -> bool:
        """Parents precede children, so their state is final."""
        parent, holds = self.regions[region]
        kept = holds and (parent < 0 or self.regions[parent][1])
        self.regions[region] = (parent, kept)
        return kept

    def read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            start = source.find("<", at)
            if start < 0:
                self.text(source[at:])
                return
            if start > at:
                self.text(source[at:start])
            after = source[start + 1 : start + 2]
            if OPENING.match(source, start):
                found = TAG.match(source, start)
                if found is None:
                    return
                at = found.end()
                name = found[2].lower()
                if found[1]:
                    self.end(name)
                else:
                    self.start(name, found[3])
                    if name in RAW:
                        closing = CLOSING[name].search(source, at)
                        if closing is None:
                            return
                        closed = source.find(">", closing.end())
                        at = end if closed < 0 else closed + 1
            elif source.startswith("<!--", start):
                at = _comment_end(source, start)
            elif after in ("!", "?", "/"):
                closed = source.find(">", start)
                at = end if closed < 0 else closed + 1
            else:
                self.text("<")
                at = start + 1

    def text(self, part: str) -> None:
        if self.left_out == 2 or self.left_out == 3 and not self.heading:
            return
        part = html.unescape(part) if "&" in part else part
        self.parts.append(part)
        if self.in_link:
            self.linked += len(part)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.page.blocks.append((self.container, text, self.linked, self.heading))
                self.regions_of_blocks.append(self.region)
        self.parts, self.linked = [], 0

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.text(" ")
            return
        if name in RAW or name in VOID and name != "hr":
            return
        block = name in BLOCKS or "-" in name
        if block:
            self.flush()
            if self.open and self.open[-1][0] == "p":
                self.pop()
        if name in ("hr", "html", "body"):
            return
        if name in IMPLIED:
            self.close_implied(*IMPLIED[name])
        attributes = {}
        for m in ATTRIBUTE.finditer(rest) if rest.strip() else ():
            attributes.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        if name == "a":
            self.in_link = "href" in attributes
        out = left_out_always(name, attributes)
        by_name = not out and name not in MAIN_TAGS and named(LEFT_OUT_WORDS, attributes)
        if not (block or out or by_name or self.left_out):
            return
        self.open.append((name, self.container, self.left_out, self.region))
        self.count[name] = self.count.get(name, 0) + 1
        if out:
            self.left_out = 2
        elif name == "header" and self.left_out != 2:
            inside = any(self.count.get(t) for t in MAIN_TAGS)
            self.left_out = 3 if inside else 2
        if name in HEADINGS:
            self.heading = True
        if self.left_out == 2:
            return
        if by_name:
            self.regions.append((self.region, False))
            self.region = len(self.regions) - 1
        elif name in MAIN_TAGS or attributes.get("itemprop", "").lower() == "articlebody":
            self.hold()
        if name in CONTAINERS or "-" in name:
            self.enter(name, attributes)

    def hold(self) -> None:
        """The regions around this place hold an article."""
        region = self.region
        while region >= 0 and not self.regions[region][1]:
            self.regions[region] = (self.regions[region][0], True)
            region = self.regions[region][0]

    def enter(self, name: str, attributes: dict[str, str]) -> None:
        depth = self.depths[self.container] + 1
        if depth > DEPTH:
            return
        tag = name
        if attributes.get("itemprop", "").lower() == "articlebody":
            tag = "article"
        elif attributes.get("role", "").strip().lower() == "main":
            tag = "main"
        page = self.page
        page.parents.append(self.container)
        page.tags.append(tag)
        page.paths.append(f"{page.paths[self.container]}/{step(name, attributes)}")
        self.depths.append(depth)
        self.container = len(page.tags) - 1

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name == "br":
            self.text(" ")
        if name in BLOCKS:
            self.flush()
        if self.count.get(name) and name not in ("html", "body"):
            while self.open[-1][0] != name:
                self.pop()
            self.pop()

    def pop(self) -> None:
        self.flush()
        name, self.container, self.left_out, self.region = self.open.pop()
        self.count[name] -= 1
        if name in BLOCKS:
            self.in_link = False
        if name in HEADINGS:
            self.heading = False

    def close_implied(self, closed: set[str], barriers: set[str]) -> None:
        if not any(self.count.get(t) for t in closed):
            return
        for back, entry in enumerate(reversed(self.open)):
            if entry[0] in barriers or back == LOOK_BACK:
                return
            if entry[0] in closed:
                for _ in range(back + 1):
                    self.pop()
                return


def _comment_end(source: str, start: int) -> int:
    for empty in ("<!-->", "<!--->"):
        if source.startswith(empty, start):
            return start + len(empty)
    found = COMMENT_END.search(source, start + 4)
    return len(source) if found is None else found.end()
