"""HTML to Markdown by a walk over the elements of a page.

Blocks are written as they close, each line behind the marks of what is open
around it: quotes, and list items with their indentation.  Links and images are
made absolute; links without text or without a target that can be followed lose
their mark, not their text.  Code keeps its white space; a table is written row by
row, its first row as the head.  A mark that is never closed, or that holds a block, marks nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from webfold.functions.batches import strings
from webfold.functions.dom import BLOCKS, Page, decode

MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
SPACES = re.compile("[\t\n\x0b\f\r \x85\xa0  -     　]+")
NOT_FOLLOWED = re.compile(r"(?i)^\s*(?:javascript|data|vbscript):")


def absolute(base: str | None, target: str) -> str:
    """The link as seen from ``base``; empty if it can't be followed."""
    if not target or NOT_FOLLOWED.match(target):
        return ""
    try:
        out = urljoin(base or "", target)
    except ValueError:
        return ""
    return out.replace(" ", "%20").replace("(", "%28").replace(")", "%29")


class _Prefix:
    """What stands before the lines of a quote or item: ``first`` once, then ``rest``."""

    def __init__(self, first: str, rest: str, item: bool = False):
        self.first, self.rest, self.item, self.used = first, rest, item, False


class _Writer:
    def __init__(self, base: str | None):
        self.base = base
        self.lines: list[str] = []
        self.prefixes: list[_Prefix] = []
        self.lists: list[list] = []  # [tag, number of the last item]
        self.inline: list[list] = [[None, "", []]]  # element, target, parts
        self.heading = 0
        self.pre = 0
        self.row: list[str] | None = None
        self.rows = 0

    def text(self, s: str) -> None:
        s = decode(s)
        self.inline[-1][2].append(s if self.pre else SPACES.sub(" ", s))

    def _taken(self) -> str:
        """What was gathered; marks still open then hold a block, so they are forgotten."""
        out = "".join(part for frame in self.inline for part in frame[2])
        self.inline = [[None, "", []]]
        return out

    def put(self, lines: list[str]) -> None:
        begins_item = any(p.item and not p.used for p in self.prefixes)
        tight = begins_item and (len(self.lists) > 1 or self.lists and self.lists[-1][1] > 1)
        if self.lines and not tight and not (self.rows > 1):
            self.lines.append("".join(p.rest for p in self.prefixes if p.used).rstrip())
        for line in lines:
            lead = ""
            for p in self.prefixes:
                lead += p.rest if p.used else p.first
                p.used = True
            self.lines.append((lead + line).rstrip() if not self.pre else lead + line)

    def flush(self) -> None:
        """End the block: what was gathered becomes its lines."""
        if self.row is not None:
            return
        s = self._taken()
        if self.pre:
            return
        lines = [line for line in (SPACES.sub(" ", x).strip() for x in s.split("\n")) if line]
        if not lines:
            return
        if self.heading:
            lines = ["#" * self.heading + " " + " ".join(lines)]
        if any(not p.item for p in self.prefixes):  # a line break in a quote is a paragraph
            for line in lines:
                self.put([line])
        else:
            self.put(lines)

    def open(self, e) -> None:
        tag = e.tag
        if tag == "br":
            self.inline[-1][2].append("\n" if self.row is None else " ")
        elif tag == "img":
            if source := absolute(self.base, e.attribute("src")):
                self.inline[-1][2].append(f"![{SPACES.sub(' ', e.attribute('alt'))}]({source})")
        elif tag == "hr":
            self.flush()
            self.put(["* * *"])
        elif (tag in MARKS or tag == "a") and not self.pre:
            self.inline.append([e, absolute(self.base, e.attribute("href")) if tag == "a" else "", []])
        elif tag in ("td", "th") and self.row is not None:
            self._taken()
        elif tag in BLOCKS:
            self.flush()
            if tag in ("ul", "ol"):
                self.lists.append([tag, 0])
            elif tag == "li":
                if not self.lists:
                    self.lists.append(["ul", 0])
                self.lists[-1][1] += 1
                mark = "- " if self.lists[-1][0] == "ul" else "1. "  # readers count themselves
                self.prefixes.append(_Prefix(mark, " " * len(mark), True))
            elif tag == "blockquote":
                self.prefixes.append(_Prefix("> ", "> "))
            elif tag == "pre":
                self.pre += 1
            elif tag[0] == "h" and tag[1:].isdigit():
                self.heading = int(tag[1:])
            elif tag == "table":
                self.rows = 0
            elif tag == "tr":
                self.row = []

    def close(self, e) -> None:
        tag = e.tag
        if self.inline[-1][0] is e:  # what was opened within it is closed by now
            _, target, parts = self.inline.pop()
            s = "".join(parts)
            core = s.strip()
            mark = MARKS.get(tag)
            if core and e.closed and (mark or target):
                lead, tail = s[:len(s) - len(s.lstrip())], s[len(s.rstrip()):]
                s = lead + (f"{mark}{core}{mark}" if mark else f"[{core}]({target})") + tail
            self.inline[-1][2].append(s)
        elif tag in ("td", "th") and self.row is not None:
            self.row.append(SPACES.sub(" ", self._taken()).strip().replace("|", "\\|"))
        elif tag == "tr" and self.row is not None:
            cells, self.row = self.row, None
            if any(cells):
                self.rows += 1
                self.put(["| " + " | ".join(cells) + " |"])
                if self.rows == 1:
                    self.rows = 2
                    self.put(["|" + " --- |" * len(cells)])
            self._taken()
        elif tag == "pre":
            code = self._taken().strip("\n")
            fence = "```"
            while fence in code:
                fence += "`"
            if code.strip():
                self.put([fence, *code.split("\n"), fence])
            self.pre -= 1
        elif tag in BLOCKS:
            self.flush()
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            elif tag in ("li", "blockquote") and self.prefixes:
                self.prefixes.pop()
            elif tag[0] == "h" and tag[1:].isdigit():
                self.heading = 0
            elif tag == "table":
                self.rows = 0


def walk(html: str | None, base: str | None = None) -> str:
    """Markdown of a piece of HTML whose links are relative to ``base``."""
    page, out = Page(html), _Writer(base)
    for event, ends in page.inside(page.root):
        if isinstance(event, str):
            out.text(event)
        elif event is not None:
            out.open(event)
        elif ends is not None:
            out.close(ends)
    out.flush()
    return "\n".join(out.lines)


def markdown(html: Column, base: Column) -> Column:
    """:func:`walk` over slices of Arrow batches."""
    def many(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return strings(walk, batches)
    return F.arrow_udf(many, StringType())(html, base)
