"""Text and HTML helpers as JVM ``Column`` expressions.

Every pattern here is written so Java regex and RE2 read it the same way
(explicit whitespace classes, ``\\z`` instead of ``$``, no back-references,
no look-around), which lets the DuckDB oracle reuse the very same strings.
Helpers that use their input more than once expect a plain column reference.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from webfold.constants import WS

# ------------------------------------------------------------------ patterns

WS_RUN = f"[{WS}]+"
NON_WS_RUN = f"[^{WS}]+"
HSPACE_RUN = r"[\t\x0B\f\r \x{85}\p{Z}]+"  # WS without '\n'
TRIM_WS = f"^[{WS}]+|[{WS}]+\\z"

# Elements whose content is never text.
PRECLEAN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|<noscript\b[^>]*>.*?(?:</noscript\s*>|\z)"
    r"|<iframe\b[^>]*>.*?(?:</iframe\s*>|\z)"
    r"|<template\b[^>]*>.*?(?:</template\s*>|\z)"
)
# Page chrome removed from the main container.
BOILERPLATE_BLOCKS = (
    r"(?is)<nav\b[^>]*>.*?</nav\s*>"
    r"|<footer\b[^>]*>.*?</footer\s*>"
    r"|<aside\b[^>]*>.*?</aside\s*>"
    r"|<form\b[^>]*>.*?</form\s*>"
)
# from the first opening to the last closing tag: nested and sibling ones lose nothing
ARTICLE_ELEM = r"(?is)(<article\b[^>]*>.*</article\s*>)"
MAIN_ELEM = r"(?is)(<main\b[^>]*>.*</main\s*>)"
BODY_INNER = r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)"
OUTER_TAGS = r"(?is)^<[a-z]+\b[^>]*>|</[a-z]+\s*>\z"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
H1 = r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"
HTML_LANG = r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([^"'\s>]*)"""
FIRST_P = r"(?is)<p\b[^>]*>(.*?)(?:</p\s*>|<p\b|\z)"
BLOCK_TAGS = (
    r"(?i)<br\s*/?>|</?(?:p|div|h[1-6]|li|ul|ol|dl|dt|dd|blockquote|pre|table|thead|tbody|tfoot"
    r"|tr|td|th|section|article|header|footer|main|aside|nav|figure|figcaption|hr|address"
    r"|details|summary)\b[^>]*>"
)
ANY_TAG = r"</?[A-Za-z][^>]*>|<![^>]*>"
NL_RUN = r" ?\n[\n ]*"


def meta_content_rx(attr: str, value: str) -> str:
    """Pattern for the whole ``<meta>`` tag whose ``attr`` equals ``value``."""
    return rf"""(?is)(<meta\b[^>]*?\s{attr}\s*=\s*["']{value}["'][^>]*>)"""


CONTENT_ATTR = r"""(?is)\scontent\s*=\s*("[^"]*"|'[^']*')"""
HREF_ATTR = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
CANONICAL_LINK = r"""(?is)(<link\b[^>]*?\srel\s*=\s*["']?canonical["'\s>][^>]*>)"""
BYLINE_ELEM = (
    r"""(?is)<(?:a|span|div|p|address)\b[^>]*?\s(?:rel\s*=\s*["']author["']"""
    r"""|class\s*=\s*["'][^"']*\b(?:byline|author)\b[^"']*["'])[^>]*>(.*?)</(?:a|span|div|p|address)\s*>"""
)
QUOTES = r"""^["']|["']\z"""

#: Named character references that end in ';', from the standard library's table of HTML names.
ENTITY_NAMES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
REFERENCE = r"^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"

# ------------------------------------------------------------------ helpers


def _codepoint_to_str(n: Column) -> Column:
    """Character for a code point; NUL, surrogates, > U+10FFFF and null (too many digits) give U+FFFD."""
    bad = n.isNull() | (n <= 0) | (n > 0x10FFFF) | ((n >= 0xD800) & (n <= 0xDFFF))
    ch = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "utf-32")
    return F.when(bad, F.lit("\ufffd")).otherwise(ch)


def decode_entities(s: Column) -> Column:
    """Named, decimal and hexadecimal character references, each decoded once.

    A text is split at '&' and every piece looks up the reference it begins
    with, so nothing is decoded twice; what is no reference stays as written.
    The argument is used once.
    """
    names = F.from_json(F.lit(json.dumps(ENTITY_NAMES)), "map<string,string>")
    parts = F.split(s, "&", -1)

    def one(x: Column) -> Column:
        name = F.regexp_extract(x, REFERENCE, 1)
        digits = F.regexp_replace(name, r"^#[xX]?0*", "")
        number = F.when(F.length(digits) <= 7, F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"))
        value = (F.when(name == "", F.lit(None).cast("string")).when(name == "amp", F.lit("&"))
                 .when(name.startswith("#"), _codepoint_to_str(F.when(digits == "", F.lit(0)).otherwise(number))).otherwise(F.try_element_at(names, name)))
        return F.when(value.isNull(), F.concat(F.lit("&"), x)).otherwise(F.concat(value, F.substr(x, F.length(name) + 2)))

    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))
    return F.concat(F.element_at(parts, 1), F.array_join(F.transform(rest, one), ""))


def decode_text(s: Column) -> Column:
    """:func:`decode_entities` of a column reference; long text without '&' is left alone."""
    return F.when(s.contains("&"), decode_entities(s)).otherwise(s)


def collapse_ws(s: Column) -> Column:
    """All whitespace runs to one space, trimmed (Unicode whitespace)."""
    return F.regexp_replace(F.regexp_replace(s, WS_RUN, " "), TRIM_WS, "")


def trim_ws(s: Column) -> Column:
    """Go ``strings.TrimSpace``: trims Unicode whitespace, not only spaces."""
    return F.regexp_replace(s, TRIM_WS, "")


def word_count(s: Column) -> Column:
    """Number of whitespace-separated fields (Go ``strings.Fields``)."""
    return F.coalesce(F.regexp_count(s, F.lit(NON_WS_RUN)), F.lit(0)).cast("int")


def strip_tags(s: Column) -> Column:
    return F.regexp_replace(s, ANY_TAG, "")


def inline_text(s: Column) -> Column:
    """Markup fragment → single-line plain text (tags off, entities decoded)."""
    return collapse_ws(decode_entities(strip_tags(s)))


def html_to_text_markup(s: Column) -> Column:
    """Step 1 of text extraction: block tags to newlines, other tags dropped."""
    return F.regexp_replace(F.regexp_replace(s, BLOCK_TAGS, "\n"), ANY_TAG, "")


def tidy_text(s: Column) -> Column:
    """Step 2: horizontal whitespace runs to one space, one newline between
    blocks, trimmed."""
    t = F.regexp_replace(s, HSPACE_RUN, " ")
    t = F.regexp_replace(t, NL_RUN, "\n")
    return F.regexp_replace(t, TRIM_WS, "")


def quoted_attr_value(s: Column) -> Column:
    return F.regexp_replace(s, QUOTES, "")


def normalize_markdown(s: Column) -> Column:
    """CRLF/CR → LF, 3+ newlines → 2, trim Unicode whitespace (in that order)."""
    t = F.replace(s, F.lit("\r\n"), F.lit("\n"))
    t = F.replace(t, F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.regexp_replace(t, TRIM_WS, "")


#: What Go's %q prints as an escape: controls, unassigned and private characters, and any space but ' '.
NOT_PRINTABLE = r"[\p{C}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]"


def go_quote(s: Column) -> Column:
    """Go ``%q`` of a string: backslash, quote, the C escapes, and other
    characters that do not print as ``\\x..``, ``\\u....`` or ``\\U........``."""
    t = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    t = F.replace(t, F.lit('"'), F.lit('\\"'))
    for ch, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\x07", "\\a"),
                    ("\x08", "\\b"), ("\x0c", "\\f"), ("\x0b", "\\v")):
        t = F.replace(t, F.lit(ch), F.lit(esc))

    def one(c: Column) -> Column:
        code = F.lower(F.regexp_replace(F.hex(F.encode(c, "utf-32")), "^0+", ""))
        escape = (F.when(F.length(code) <= 2, F.when(code < "80", F.concat(F.lit("\\x"), F.lpad(code, 2, "0"))).otherwise(F.concat(F.lit("\\u"), F.lpad(code, 4, "0"))))
                  .when(F.length(code) <= 4, F.concat(F.lit("\\u"), F.lpad(code, 4, "0"))).otherwise(F.concat(F.lit("\\U"), F.lpad(code, 8, "0"))))
        return F.when(c.rlike(NOT_PRINTABLE), escape).otherwise(c)
    t = F.when(s.rlike(NOT_PRINTABLE), F.array_join(F.transform(F.split(t, ""), one), "")).otherwise(t)
    return F.concat(F.lit('"'), t, F.lit('"'))


def rfc3339(ts: Column) -> Column:
    """UTC RFC 3339 with seconds and 'Z' (session time zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
