"""A lenient HTML reader: block elements and the text runs between them, as a tree in arrays.

Inline markup belongs to the run it stands in; a run ends where a block
element begins or ends.  Scripts, styles, comments and the head are dropped.
Elements that are left open are closed where HTML implies it.
"""

from __future__ import annotations

import re
from html import unescape

# fixed values: HTML element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("script style title template iframe object noembed noframes svg math".split())
IN_HEAD = frozenset("base link meta noscript script style title template".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre search section table ul".split())
SAME_GROUP = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
              "option": ("option",), "thead": ("tr", "td", "th", "tbody", "thead"), "tbody": ("tr", "td", "th", "tbody", "thead"),
              "tfoot": ("tr", "td", "th", "tbody", "thead")}
SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select", "datalist")}  # else: table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(next((g for g in m.groups()[1:] if g is not None), "")) for m in _ATTRIBUTE.finditer(source)}


class Tree:
    """Node k has ``parent[k]`` (-1: the root), ``tag[k]`` ("" for a run), ``attrs[k]`` (source) and for runs ``text[k]``, ``linked[k]``."""

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.attrs: list[str] = []
        self.text: list[str] = []
        self.linked: list[int] = []  # characters of a run inside <a>

    def add(self, parent: int, tag: str, attrs: str = "", text: str = "", linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


_BLOCKS_INLINE = frozenset(CLOSES_P) | SAME_GROUP.keys()


def read(html: str | None) -> Tree:
    tree = Tree()
    stack: list[tuple[str, int]] = [("", tree.add(-1, "html"))]  # open elements; inline ones carry their block's node
    pieces: list[str] = []
    links = 0  # open <a>
    linked = 0

    depths: dict[str, list[int]] = {}  # places of the open elements of each name

    def push(name: str, node: int) -> None:
        depths.setdefault(name, []).append(len(stack))
        stack.append((name, node))

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tree.add(stack[-1][1], "", "", text, min(linked, len(text)))
            pieces.clear()
        linked = 0

    def close(depth: int) -> None:
        """Close all elements from stack position ``depth`` on."""
        nonlocal links
        if any(name not in INLINE for name, _ in stack[depth:]):
            flush()
        links -= sum(name == "a" for name, _ in stack[depth:])
        for name, _ in stack[depth:]:
            depths[name].pop()
        del stack[depth:]

    def deepest(names) -> int:
        return max((d[-1] for name in names if (d := depths.get(name))), default=0)

    def find(names, stop) -> int:
        """Place of the innermost open element of ``names``, 0 if one of ``stop`` is nearer or there is none."""
        k = deepest(names)
        return k if k and k >= deepest(stop) else 0

    def words(text: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head":
            if not text.strip():
                return
            close(len(stack) - 1)
        text = unescape(text) if "&" in text else text
        pieces.append(text)
        if links:
            linked += len(text.strip())

    html = html or ""
    at = 0
    while (m := _TOKEN.search(html, at)) is not None:
        if m.start() > at:
            words(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                words(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("br", "p") and not find((tag,), ()):
                flush()
            elif k := find((tag,), () if tag not in INLINE else _BLOCKS_INLINE):
                close(k)
            continue
        if tag in DROPPED:
            if not m[3].endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "html" or tag == "body" and find(("body",), ()):
            continue
        if tag not in IN_HEAD and stack[-1][0] == "head":
            close(len(stack) - 1)
        if tag in INLINE or tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag == "hr":
                if k := find(("p",), ()):
                    close(k)
                flush()
            if tag not in VOID:
                if tag == "a":
                    if k := find(("a",), CLOSES_P):
                        close(k)
                    links += 1
                push(tag, stack[-1][1])
            continue
        if tag in CLOSES_P and (k := find(("p",), ("button", "td", "th", "table", "object", "caption"))):
            close(k)
        elif tag in SAME_GROUP:
            scope = SCOPE.get(tag, ("table",))
            while k := find(SAME_GROUP[tag], scope):
                close(k)
        flush()
        push(tag, tree.add(stack[-1][1], tag, m[3]))
    if at < len(html):
        words(html[at:])
    flush()
    return tree
