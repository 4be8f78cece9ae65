"""A lenient reading of HTML into block-level nodes and the text they hold, in page order."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
                   "time tt u var img label "
                   "math mrow mi mn mo ms mtext mfrac msqrt mroot msup msub msubsup munder mover munderover mstyle mpadded semantics".split())
SILENT = frozenset("script style noscript template head title svg annotation iframe object canvas audio video button select option textarea map".split())
RAW = frozenset("script style textarea title noscript iframe".split())
#: A start tag of the key ends an open element of the value.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "tbody": ("thead", "tbody", "tr", "td", "th"), "option": ("option",)}
#: Elements that an implied end does not reach beyond.
SCOPE = frozenset("table ul ol dl td th div article section main body html nav aside header footer form blockquote".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")
#: Open elements that are looked at one by one before the places of tags are looked up.
_NEAR = 16
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


@dataclass
class Page:
    """Block nodes by number (a parent comes before its children; node 0 is the page) and text pieces in order.

    A piece is (node, text); node -1 stands for the edge of a block.
    """

    tags: list[str] = field(default_factory=lambda: ["html"])
    parents: list[int] = field(default_factory=lambda: [0])
    tokens: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marks: list[str] = field(default_factory=lambda: [""])
    links: list[int] = field(default_factory=lambda: [0])
    pieces: list[tuple[int, str]] = field(default_factory=list)


def _attributes(text: str) -> tuple[tuple[str, ...], str]:
    tokens, mark = [], ""
    for name, a, b, c in _ATTRIBUTE.findall(text):
        value = (a or b or c).lower()
        if name.lower() == "data-y":
            mark = value
        else:
            tokens += _TOKEN.findall(value)
    return tuple(dict.fromkeys(tokens)), mark


class _Ends:
    """Where tags end: at the first ``>`` outside quotes, or, if there is none, at the first ``>``.

    A scan that finds no end notes the quotes it opened; one that comes to
    such a quote has no end either. The next special character is kept as
    well, so that all scans of a page together take linear time.
    """

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.endless: set[int] = set()
        self.known = (0, -1)  # the next special character of every place from the first to the second

    def _special(self, at: int) -> int:
        if not self.known[0] <= at <= self.known[1]:
            m = _SPECIAL.search(self.html, at)
            self.known = (at, m.start() if m else len(self.html))
        return self.known[1]

    def find(self, at: int) -> int:
        """Place of the ``>`` of a tag whose name ends at ``at``; -1 if nothing ends after it."""
        if at > self.last:
            return -1
        first, opened = at, []
        while (k := self._special(at)) < len(self.html):
            if self.html[k] == ">":
                return k
            if k in self.endless:
                break
            opened.append(k)
            at = self.html.find(self.html[k], k + 1) + 1
            if not at:
                break
        self.endless.update(opened)
        return self.html.find(">", first)


class _Open:
    """Open elements with the block node that their text belongs to, and where each tag is open."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("html", 0)]
        self.places: dict[str, list[int]] = {"html": [0]}

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))

    def pop(self) -> str:
        tag, _ = self.stack.pop()
        self.places[tag].pop()
        return tag

    def has(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def find(self, tags: tuple[str, ...], limit: frozenset[str] = frozenset()) -> int:
        """The innermost open element of ``tags``, 0 if there is none above the innermost one of ``limit``."""
        if not any(self.places.get(t) for t in tags):
            return 0
        low = max(0, len(self.stack) - 1 - _NEAR)
        for k in range(len(self.stack) - 1, low, -1):
            if self.stack[k][0] in tags:
                return k
            if self.stack[k][0] in limit:
                return 0
        k = max(self.places[t][-1] for t in tags if self.places.get(t))
        return k if all(self.places[t][-1] <= k for t in limit if self.places.get(t)) else 0


def read(html: str, apart: frozenset[str] = frozenset()) -> Page:
    """Nodes of a page, in time linear in its length.

    Block elements are nodes, and inline ones with one of the class, id or
    role tokens of ``apart``.
    """
    page = Page()
    opened, ends = _Open(), _Ends(html)
    stack = opened.stack
    silent = links = 0  # how many open elements are silent, are links
    at = look = 0  # text that is not yet read, and where to look for the next tag

    def add(text: str) -> None:
        if silent or not text:
            return
        if "&" in text:
            text = unescape(text)
        node = stack[-1][1]
        page.pieces.append((node, text))
        if links:
            page.links[node] += len(text.strip())

    def close(depth: int) -> None:
        nonlocal silent, links
        while len(stack) > depth:
            tag = opened.pop()
            silent -= tag in SILENT
            links -= tag == "a"
            if tag not in INLINE:
                page.pieces.append((-1, " "))

    while (start := html.find("<", look)) >= 0:
        m = None
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4) + 2
            end = end if end > 1 else len(html) - 1
        elif html.startswith(("<!", "<?"), start):
            end = html.find(">", start) if start <= ends.last else -1
        else:
            m = _NAME.match(html, start + 1) if start < ends.last else None
            end = ends.find(m.end()) if m else -1
        if end < 0:
            look = start + 1
            continue
        add(html[at:start])
        at = look = end + 1
        if m is None:
            continue
        tag, rest = m[2].lower(), html[m.end():end]
        if m[1]:
            if k := opened.find((tag,)):
                close(k)
            elif tag == "br":
                page.pieces.append((-1, " "))
            continue
        if tag in VOID:
            if tag not in INLINE and not silent:
                page.pieces.append((-1, " "))
            continue
        if tag == "html" or tag == "body" and opened.has("body"):
            continue
        if tag not in INLINE:
            if k := opened.find(ENDS.get(tag, ()), SCOPE - {"td", "th"} if tag in ("tr", "tbody") else SCOPE - {tag, "td", "th"} if tag in ("td", "th") else SCOPE):
                close(k)
            elif k := opened.find(("p", "h1", "h2", "h3", "h4", "h5", "h6"), SCOPE):
                close(k)
            if tag == "body" and (k := opened.find(("head",))):
                close(k)
        if rest.endswith("/") and tag in ("svg", "path", "use"):
            continue
        node = stack[-1][1]
        if tag not in SILENT and not silent:
            tokens, mark = _attributes(rest) if rest else ((), "")
            if tag not in INLINE or apart.intersection(tokens):
                node = len(page.tags)
                page.tags.append(tag), page.parents.append(stack[-1][1]), page.tokens.append(tokens), page.marks.append(mark), page.links.append(0)
        if tag not in INLINE:
            page.pieces.append((-1, " "))
        opened.push(tag, node)
        silent += tag in SILENT
        links += tag == "a"
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = look = end.start() if end else len(html)
    add(html[at:])
    return page
