"""Elements of an HTML page by a stack of open tags, for rules that regular expressions can't say.

A page becomes a flat list of events (an element opens, text, an element
closes), so that every later pass is a loop, whatever the depth.  Attributes may
hold ``>`` in quotes; ``script``, ``style`` and the like are skipped to their own closing tag (or
the end of the page); a comment that never ends takes the rest.  End tags may be missing: a block
ends an open paragraph, an item the item before it, a row the cell before it,
and a closing tag all that is still open inside its element.  A closing tag without an element is
ignored.  Lookups of what is open are by tag, so the work is linear in the page.
"""

from __future__ import annotations

import re
from html.entities import html5

# a quoted value runs to its quote; without one, the tag ends at the next '>'
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    r"""|<(/?)([A-Za-z][A-Za-z0-9:_-]*)((?:[^"'<>]++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([A-Za-z][A-Za-z0-9:_-]*)([^<>]*+)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?""")
REFERENCE = re.compile(r"&(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);")

# fixed values: elements by their role in HTML
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset("script style noscript iframe template".split())
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th section article header footer main "
    "aside nav figure figcaption hr address details summary form fieldset body html".split())
CHROME = frozenset("nav footer aside form".split())
PROSE = frozenset("p pre blockquote li td dd h1 h2 h3 h4 h5 h6".split())
#: An opening tag ends these, if they are open within the nearest of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
        **{t: ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}) for t in ("thead", "tbody", "tfoot")}}
PARAGRAPH_SCOPE = frozenset("td th table caption button".split())
_CLOSE = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in (*SKIPPED, "title")}
BANNER = re.compile(r"(?:^|[\s_-])(?:cookies?|consent|gdpr)(?:$|[\s_-])", re.I)


class Element:
    __slots__ = ("tag", "parent", "source", "first", "last", "closed")

    def __init__(self, tag: str, parent: Element | None, source: str, first: int):
        self.tag, self.parent, self.source, self.first, self.last, self.closed = tag, parent, source, first, first, False

    def attribute(self, name: str) -> str:
        for key, value in ATTRIBUTE.findall(self.source):
            if key.lower() == name:
                return decode(value[1:-1] if value[:1] in "\"'" else value).strip()
        return ""


def decode(text: str) -> str:
    """Character references that end in ';', each once."""
    def one(m: re.Match) -> str:
        name = m[1]
        if name[0] != "#":
            return html5.get(name + ";", m[0])
        digits = name[2:] if name[1] in "xX" else name[1:]
        point = int(digits, 16 if name[1] in "xX" else 10) if len(digits.lstrip("0")) <= 7 else 0x110000
        return chr(point) if 0 < point < 0x110000 and not 0xD800 <= point <= 0xDFFF else "�"
    return REFERENCE.sub(one, text) if "&" in text else text


class Page:
    """``events``: an element where it opens, a string of (undecoded) text, None where an element closes (``closing`` tells which)."""

    def __init__(self, html: str | None):
        self.events: list[Element | str | None] = []
        self.closing: dict[int, Element] = {}
        self.elements: list[Element] = []
        self._open: list[Element] = []
        self._depths: dict[str, list[int]] = {}
        self._push("#page", "")
        self._read(html or "")
        while self._open:
            self._pop()

    @property
    def root(self) -> Element:
        return self.elements[0]

    def _push(self, tag: str, source: str) -> Element:
        element = Element(tag, self._open[-1] if self._open else None, source, len(self.events))
        self._depths.setdefault(tag, []).append(len(self._open))
        self._open.append(element)
        self.elements.append(element)
        self.events.append(element)
        return element

    def _pop(self) -> Element:
        element = self._open.pop()
        self._depths[element.tag].pop()
        element.last = len(self.events)
        self.closing[element.last] = element
        self.events.append(None)
        return element

    def _deepest(self, tags) -> int:
        return max((d[-1] for t in tags if (d := self._depths.get(t))), default=-1)

    def _end(self, tags, scope) -> None:
        """Close the outermost open element of ``tags`` within the nearest of ``scope``."""
        bound = self._deepest(scope)
        while self._deepest(tags) > bound:
            depth = self._deepest(tags)
            while len(self._open) > depth:
                self._pop()

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = TOKEN.search(html, at)
            if m is None:
                self.events.append(html[at:])
                return
            if m.start() > at:
                self.events.append(html[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                depths = self._depths.get(tag)
                if depths:
                    while len(self._open) > depths[-1] + 1:
                        self._pop()
                    self._pop().closed = True
                elif tag == "br":
                    self._push(tag, "")
                    self._pop()
                continue
            if tag in SKIPPED or tag == "title":
                close = _CLOSE[tag].search(html, at)
                if close or tag != "title":
                    at = close.end() if close else size
                continue
            if tag in BLOCKS:
                self._end(("p",), PARAGRAPH_SCOPE)
            if tag in ENDS:
                self._end(*ENDS[tag])
            self._push(tag, m[3] if m[2] else m[6] or "")
            if tag in VOID:
                self._pop()

    def inside(self, element: Element, without=frozenset()):
        """Events within an element, but for the subtrees of ``without``; closing ones as (None, element)."""
        at = element.first + 1
        while at < element.last:
            event = self.events[at]
            if event in without and not isinstance(event, str):
                at = event.last + 1
                continue
            yield (event, self.closing.get(at))
            at += 1

    def removed(self) -> set[Element]:
        """Page chrome: navigation, footers, asides and forms that are closed, and consent banners; the outermost of each."""
        out: set[Element] = set()
        until = -1
        for e in self.elements[1:]:
            if e.first > until and e.closed and e.tag not in ("html", "body", "article", "main") and (
                    e.tag in CHROME or (e.source and BANNER.search(f"{e.attribute('id')} {e.attribute('class')}"))):
                out.add(e)
                until = e.last
        return out

    def outermost(self, tag: str, without: set[Element]) -> list[Element]:
        out, until = [], -1
        for e in self.elements:
            if e.first <= until:
                continue
            if e in without:
                until = e.last
            elif e.tag == tag:
                out.append(e)
                until = e.last
        return out

    def densest(self, without: set[Element]) -> list[Element]:
        """The block that holds most prose, with its siblings that hold prose too; the page if there is none.

        Words count for the block they stand in, words of links against it.  Prose elements lend their weight to
        the parent block and half of it to the next; other blocks keep theirs.
        """
        blocks, weight, links = [self.root], {self.root: 0.0}, 0
        score: dict[Element, float] = {}
        for event, ends in self.inside(self.root, without):
            if isinstance(event, str):
                n = len(event.split())
                weight[blocks[-1]] += -n if links else n
            elif event is not None:
                links += event.tag == "a"
                if event.tag in BLOCKS:
                    blocks.append(event)
                    weight[event] = 0.0
            elif ends is not None:
                links -= ends.tag == "a"
                if ends.tag in BLOCKS:
                    blocks.pop()
                    if weight[ends] > 0:
                        takers = [ends] if ends.tag not in PROSE else blocks[-1:-3:-1]
                        for share, block in zip((1.0, 0.5), takers):
                            score[block] = score.get(block, 0.0) + share * weight[ends]
        if weight[self.root] > 0:
            score[self.root] = score.get(self.root, 0.0) + weight[self.root]
        if not score:
            return [self.root]
        best = max(score, key=lambda e: (score[e], -e.first))
        near = [e for e in weight if e.parent is best.parent and e is not best and score.get(e, 0.0) >= 0.2 * score[best]
                or e.parent is best.parent and e.tag == "p" and weight[e] >= 25]
        return sorted([best, *near], key=lambda e: e.first)


def _tag(element: Element) -> str:
    source = element.source
    if "<" in source or ">" in source:
        source = source.replace("<", "&lt;").replace(">", "&gt;")
    return f"<{element.tag}{source}>"


def main_content(html: str | None) -> str:
    """Markup of the main content: the articles, else the main element, else the densest block, without page chrome.

    Elements that were closed are closed; ``<`` and ``>`` within attributes are references, so that patterns can
    read the result.
    """
    page = Page(html)
    without = page.removed()
    found = page.outermost("article", without) or page.outermost("main", without) or page.densest(without)
    out = []
    for element in found:
        if len(found) > 1:
            out.append(f"<{element.tag}>")
        for event, ends in page.inside(element, without):
            if isinstance(event, str):
                out.append(event)
            elif event is not None:
                out.append(_tag(event))
            elif ends is not None and ends.closed:
                out.append(f"</{ends.tag}>")
        if len(found) > 1:
            out.append(f"</{element.tag}>")
    return "".join(out)
