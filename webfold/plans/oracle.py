"""DuckDB SQL for the correctness oracle.

The same rules as the Spark code, written independently in DuckDB's dialect
(RE2 regexes, ``'g'`` for replace-all, ``\\1`` groups, ``lambda x:`` lists).
Pattern *constants* of URLs and plain text are shared with the Spark modules on
purpose: they are the rule, and both engines must read them the same way; the code
around them is not shared.  Main content and Markdown are found by patterns here
and by a walk over the elements there.

A query is a chain of CTEs; :class:`Chain` appends ``SELECT *, <exprs>``
steps so that each expensive expression is computed once and later steps
refer to it by name.
"""

from __future__ import annotations

from webfold.constants import (ARTICLE_PATTERNS, BLACKLIST_SEGMENTS, TRACKING_PARAMS)
from webfold.functions import text as T
from webfold.functions import urls as U


# Markdown by ordered rewrites; the Spark side walks the elements instead, and shares none of this.
MARKDOWN_RULES: list[tuple[str, str]] = [
    (r"(?is)<pre\b[^>]*>\s*(?:<code\b[^>]*>)?", "\n\n```\n"),
    (r"(?is)(?:</code\s*>\s*)?</pre\s*>", "\n```\n\n"),
    (r"(?i)<h1\b[^>]*>", "\n\n# "),
    (r"(?i)<h2\b[^>]*>", "\n\n## "),
    (r"(?i)<h3\b[^>]*>", "\n\n### "),
    (r"(?i)<h4\b[^>]*>", "\n\n#### "),
    (r"(?i)<h5\b[^>]*>", "\n\n##### "),
    (r"(?i)<h6\b[^>]*>", "\n\n###### "),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    # inner marks first, so that either may stand in the other
    (r"(?is)<code\b[^>]*>([^<]*)</code\s*>", "`$1`"),
    (r"(?is)<(?:i|em)\b[^>]*>([^<]*)</(?:i|em)\s*>", "*$1*"),
    (r"(?is)<(?:b|strong)\b[^>]*>([^<]*)</(?:b|strong)\s*>", "**$1**"),
    (r"(?is)<(?:i|em)\b[^>]*>([^<]*)</(?:i|em)\s*>", "*$1*"),
    (r"""(?is)<a\b[^>]*?\shref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>""", "[$2]($1)"),
    (r"""(?is)<a\b[^>]*?\shref\s*=\s*'([^']*)'[^>]*>(.*?)</a\s*>""", "[$2]($1)"),
    (r"""(?is)<a\b[^>]*?\shref\s*=\s*([^\s"'>]+)[^>]*>(.*?)</a\s*>""", "[$2]($1)"),
    (r"""(?is)<img\b[^>]*?\ssrc\s*=\s*"([^"]*)"[^>]*>""", "![]($1)"),
    (r"(?i)<li\b[^>]*>", "\n- "),
    (r"(?i)</li\s*>", ""),
    (r"(?i)</?(?:ul|ol)\b[^>]*>", "\n\n"),
    (r"(?i)<blockquote\b[^>]*>", "\n\n> "),  # a quote left open
    (r"(?i)</blockquote\s*>", "\n\n"),
    (r"(?i)<hr\b[^>]*>", "\n\n* * *\n\n"),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</?(?:p|div|section|article|header|footer|main|table|thead|tbody|tr|figure|figcaption"
     r"|dl|dt|dd|address|details|summary)\b[^>]*>", "\n\n"),
    (r"(?i)</?(?:td|th)\b[^>]*>", " "),
    (r"</?[A-Za-z][^>]*>|<![^>]*>", ""),
]
# after entity decoding: horizontal whitespace runs → one space, spaces
# around line breaks dropped, but for fenced code
MD_HSPACE = r"[\t\x0B\f \x{85}\p{Z}]+"
MD_LINE_EDGES = r" *\n *"
FENCE = "```"
OL_OPEN, OL_INSIDE = r"(?i)<ol\b[^>]*>", r"(?is)^(.*?)(?:</ol\s*>|\z)"
QUOTE_OPEN, QUOTE_INSIDE = r"(?i)<blockquote\b[^>]*>", r"(?is)^(.*?)(?:</blockquote\s*>|\z)"
ITEM, QUOTE_BREAK = r"(?i)<li\b[^>]*>", r"(?is)(?:\s|<br\s*/?>|</?p\b[^>]*>)*(?:<br\s*/?>|</?p\b[^>]*>)(?:\s|<br\s*/?>|</?p\b[^>]*>)*"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx_extract(e: str, pat: str, i: int = 0) -> str:
    return f"regexp_extract({e}, {q(pat)}, {i})"


def rx_like(e: str, pat: str) -> str:
    return f"regexp_matches({e}, {q(pat)})"


def rx_replace(e: str, pat: str, rep: str) -> str:
    return f"regexp_replace({e}, {q(pat)}, {q(rep)}, 'g')"


def dollar_to_backslash(rep: str) -> str:
    out, i = [], 0
    while i < len(rep):
        if rep[i] == "$" and i + 1 < len(rep) and rep[i + 1].isdigit():
            out.append("\\" + rep[i + 1])
            i += 2
        else:
            out.append(rep[i])
            i += 1
    return "".join(out)


class Chain:
    def __init__(self, source: str, name: str = "s"):
        self.ctes = [(f"{name}0", source)]
        self.name = name

    @property
    def last(self) -> str:
        return self.ctes[-1][0]

    def add(self, cols: dict[str, str], where: str | None = None) -> "Chain":
        body = ", ".join(f"{e} AS {k}" for k, e in cols.items())
        w = f" WHERE {where}" if where else ""
        self.ctes.append((f"{self.name}{len(self.ctes)}", f"SELECT *, {body} FROM {self.last}{w}"))
        return self

    def step(self, sql_using_prev: str) -> "Chain":
        """Arbitrary step; ``{prev}`` is replaced by the previous CTE name."""
        self.ctes.append((f"{self.name}{len(self.ctes)}", sql_using_prev.replace("{prev}", self.last)))
        return self

    def sql(self, final: str) -> str:
        withs = ",\n".join(f"{n} AS ({s})" for n, s in self.ctes)
        return f"WITH {withs}\n{final.replace('{prev}', self.last)}"


# ------------------------------------------------------------------ URL pieces

def query_escape(e: str) -> str:
    return f"replace(url_encode({e}), '%20', '+')"


def path_escape(e: str) -> str:
    out = f"url_encode({e})"
    for code, ch in (("%2F", "/"), ("%24", "$"), ("%26", "&"), ("%2B", "+"), ("%2C", ","),
                     ("%3A", ":"), ("%3B", ";"), ("%3D", "="), ("%40", "@")):
        out = f"replace({out}, {q(code)}, {q(ch)})"
    return out


def canonical_query(e: str) -> str:
    keys = ", ".join(q(k) for k in TRACKING_PARAMS)
    pairs = f"list_filter(string_split({e}, '&'), lambda p: p <> '' AND NOT contains(p, ';'))"
    kv = (f"list_transform({pairs}, lambda p: {{'k': {rx_extract('p', '^([^=]*)', 1)}, "
          f"'v': CASE WHEN contains(p, '=') THEN {rx_extract('p', '(?s)^[^=]*=(.*)$', 1)} ELSE '' END}})")
    kv = f"list_filter({kv}, lambda x: NOT {rx_like('x.k', U.BAD_ESCAPE)} AND NOT {rx_like('x.v', U.BAD_ESCAPE)})"
    dec = (f"list_transform({kv}, lambda x: {{'k': url_decode(replace(x.k, '+', ' ')), "
           f"'v': url_decode(replace(x.v, '+', ' '))}})")
    kept = f"list_filter({dec}, lambda x: lower(x.k) NOT IN ({keys}))"
    enc = f"list_transform(list_sort({kept}), lambda x: {query_escape('x.k')} || '=' || {query_escape('x.v')})"
    return f"array_to_string({enc}, '&')"


def parse_url_cols(c: Chain, src: str, p: str) -> Chain:
    """Same parts as :func:`webfold.functions.urls.parse_urls`, same names."""
    g = lambda i: rx_extract(src, U._RFC3986_DOTALL, i)
    c.add({f"{p}_g1": g(1), f"{p}_g2": g(2), f"{p}_g3": g(3), f"{p}_g4": g(4), f"{p}_g5": g(5),
           f"{p}_g6": g(6), f"{p}_g7": g(7), f"{p}_g9": g(9),
           f"{p}_prefrag": rx_extract(src, r"(?s)^([^#]*)", 1)})
    no_auth = f"({p}_g1 = '' AND {p}_g3 <> '' AND {p}_g4 = '')"
    c.add({
        f"{p}_has_scheme": f"{p}_g1 <> ''",
        f"{p}_scheme": f"lower({p}_g2)",
        f"{p}_has_auth": f"({p}_g3 <> '' AND NOT {no_auth})",
        f"{p}_rawpath": f"CASE WHEN {no_auth} THEN '//' || {p}_g5 ELSE {p}_g5 END",
        f"{p}_userinfo": rx_extract(f"{p}_g4", r"^(.*@)?[^@]*$", 1),
        f"{p}_hostport": rx_extract(f"{p}_g4", r"^(?:.*@)?([^@]*)$", 1),
        f"{p}_has_query": f"{p}_g6 <> ''",
        f"{p}_query": f"{p}_g7",
    })
    hp, rp = f"{p}_hostport", f"{p}_rawpath"
    first_seg = rx_extract(rp, r"^([^/]*)", 1)
    port_ok = f"(starts_with({hp}, '[') OR NOT {rx_like(hp, U.BAD_PORT)})"
    ok = (f"({src} IS NOT NULL AND NOT {rx_like(f'{p}_prefrag', U.CTL)}"
          f" AND (NOT {p}_has_scheme OR {rx_like(f'{p}_g2', U.SCHEME_OK)})"
          f" AND NOT (NOT {p}_has_scheme AND NOT starts_with({rp}, '/') AND contains({first_seg}, ':'))"
          f" AND (NOT {p}_has_auth OR ({port_ok} AND NOT {rx_like(hp, U.BAD_HOST_CHAR)}))"
          f" AND NOT {rx_like(rp, U.BAD_ESCAPE)} AND NOT {rx_like(f'{p}_g9', U.BAD_ESCAPE)})")
    opaque = f"({p}_has_scheme AND NOT starts_with({rp}, '/') AND NOT {p}_has_auth)"
    host = (f"CASE WHEN {p}_has_auth THEN lower(CASE WHEN starts_with({hp}, '[') THEN "
            f"{rx_extract(hp, r'^\[([^\]]*)\]', 1)} ELSE {rx_replace(hp, r':[^:]*$', '')} END) ELSE '' END")
    c.add({
        f"{p}_ok": f"coalesce({ok}, false)",
        f"{p}_opaque": opaque,
        f"{p}_host": host,
        f"{p}_path": f"CASE WHEN {opaque} THEN '' ELSE url_decode({rp}) END",
    })
    return c


def normalize_cols(c: Chain, src: str, out: str, p: str | None = None) -> Chain:
    p = p or f"_{out}"
    parse_url_cols(c, src, p)
    c.add({f"{p}_cq": canonical_query(f"{p}_query")})
    rp, dec = f"{p}_rawpath", f"{p}_path"
    out_path = (f"CASE WHEN length({dec}) > 1 AND ends_with({dec}, '/') THEN {path_escape(rx_replace(dec, '/+$', ''))}"
                f" WHEN {rx_like(rp, U.PATH_VALID_ENCODED)} THEN {rp} ELSE {path_escape(dec)} END")
    c.add({f"{p}_outpath": out_path})
    qp = (f"CASE WHEN {p}_has_query AND {p}_query = '' THEN '?' "
          f"WHEN {p}_has_query AND {p}_cq <> '' THEN '?' || {p}_cq ELSE '' END")
    hpl = f"lower({p}_hostport)"
    auth = (f"CASE WHEN {p}_has_auth AND ({hpl} <> '' OR {rp} <> '' OR {p}_userinfo <> '') "
            f"THEN '//' || {p}_userinfo || {hpl} ELSE '' END")
    body = f"CASE WHEN {p}_opaque THEN {rp} ELSE {auth} || {p}_outpath END"
    norm = f"CASE WHEN {p}_has_scheme THEN {p}_scheme || ':' ELSE '' END || {body} || {qp}"
    c.add({out: f"CASE WHEN {p}_ok THEN {norm} END"})
    return c


def relative_path_cols(c: Chain, norm: str, out: str) -> Chain:
    p = f"_{out}"
    parse_url_cols(c, norm, p)
    c.add({f"{p}_orig": rx_replace(f"{p}_path", r"^/+|/+$", "")})
    o = f"{p}_orig"
    p0 = f"CASE WHEN {o} = '' THEN 'index' ELSE {o} END"
    stripped = rx_replace(rx_replace(p0, r"\.html$", ""), r"\.htm$", "")
    c.add({f"{p}_clean": f"CASE WHEN {stripped} = '' THEN 'index' ELSE {stripped} END"})
    cl = f"{p}_clean"
    segs = f"list_concat(['pages', {p}_host], string_split({cl}, '/'))"
    fold = (f"list_reduce({segs}, lambda acc, s: CASE WHEN s = '' OR s = '.' THEN acc "
            f"WHEN s = '..' AND len(acc) > 0 AND acc[-1] <> '..' THEN acc[1:len(acc) - 1] "
            f"ELSE list_append(acc, s) END, []::VARCHAR[])")
    base = f"array_to_string({fold}, '/')"
    lossy = f"({p}_query <> '' OR ({o} <> '' AND {cl} <> {o}))"
    rel = f"CASE WHEN {lossy} THEN {base} || '--' || substr(sha256({norm}), 1, 6) || '.md' ELSE {base} || '.md' END"
    c.add({out: f"CASE WHEN {norm} IS NOT NULL AND {p}_host <> '' THEN {rel} END"})
    return c


def remove_dot_segments(e: str) -> str:
    elems = f"string_split({e}, '/')"
    fold = (f"list_reduce({elems}, lambda acc, x: CASE WHEN x = '.' THEN acc WHEN x = '..' THEN acc[1:len(acc) - 1] "
            f"ELSE list_append(acc, x) END, []::VARCHAR[])")
    r = f"('/' || array_to_string({fold}, '/') || CASE WHEN {elems}[-1] IN ('.', '..') THEN '/' ELSE '' END)"
    return f"CASE WHEN {e} = '' THEN '' WHEN starts_with({r}, '//') THEN substr({r}, 2) ELSE {r} END"


def resolve_cols(c: Chain, base: str, ref: str, out: str) -> Chain:
    b, r = f"_{out}_b", f"_{out}_r"
    parse_url_cols(c, base, b)
    parse_url_cols(c, ref, r)
    rp, bp = f"{r}_rawpath", f"{b}_rawpath"
    merged = (f"CASE WHEN starts_with({rp}, '/') THEN {rp} WHEN {b}_has_auth AND {bp} = '' THEN '/' || {rp} "
              f"ELSE {rx_extract(bp, r'^(.*/)?[^/]*$', 1)} || {rp} END")
    c.add({f"{out}_m": f"CASE WHEN {r}_has_scheme OR {r}_has_auth THEN {rp} WHEN {rp} = '' THEN {bp} ELSE {merged} END"})
    m = f"{out}_m"

    def qq(x):
        return f"CASE WHEN {x}_has_query THEN '?' || {x}_query ELSE '' END"

    scheme = f"CASE WHEN {r}_has_scheme THEN {r}_scheme ELSE {b}_scheme END"
    scheme_part = f"CASE WHEN ({scheme}) <> '' THEN ({scheme}) || ':' ELSE '' END"
    path = f"CASE WHEN {r}_opaque THEN {rp} ELSE {remove_dot_segments(m)} END"
    absolute = (f"{scheme_part} || CASE WHEN {r}_has_auth THEN '//' || {r}_userinfo || {r}_hostport ELSE '' END"
                f" || {path} || {qq(r)}")
    from_base = (f"{scheme_part} || CASE WHEN {b}_has_auth THEN '//' || {b}_userinfo || {b}_hostport ELSE '' END"
                 f" || {path} || CASE WHEN {rp} = '' AND NOT {r}_has_query THEN {qq(b)} ELSE {qq(r)} END")
    res = f"CASE WHEN {r}_has_scheme OR {r}_has_auth THEN {absolute} ELSE {from_base} END"
    c.add({out: f"CASE WHEN NOT starts_with({ref}, '#') AND {b}_ok AND {r}_ok THEN {res} END"})
    return c


BLACKLIST_RX = "|".join(s.replace(".", r"\.") for s in BLACKLIST_SEGMENTS)
ARTICLE_RX = "|".join(ARTICLE_PATTERNS)


def is_blacklisted(path: str) -> str:
    return rx_like(f"lower({path})", BLACKLIST_RX)


def is_article(path: str) -> str:
    return rx_like(f"lower({path})", ARTICLE_RX)


# ------------------------------------------------------------------ text pieces

def _cp(n: str) -> str:
    return (f"CASE WHEN {n} IS NULL OR {n} <= 0 OR {n} > 1114111 OR ({n} >= 55296 AND {n} <= 57343) "
            f"THEN {q(chr(0xFFFD))} ELSE chr({n}::INTEGER) END")


def decode_entities(e: str) -> str:
    """Split at '&'; each piece begins with a reference or stays as it is."""
    names = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in T.ENTITY_NAMES.items()) + "}"
    name = rx_extract("x", T.REFERENCE, 1)
    digits = rx_replace(name, "^#[xX]?0*", "")
    number = (f"(CASE WHEN {digits} = '' THEN 0 WHEN length({digits}) > 7 THEN NULL WHEN regexp_matches({name}, '^#[xX]') "
              f"THEN TRY_CAST('0x' || {digits} AS BIGINT) ELSE TRY_CAST({digits} AS BIGINT) END)")
    value = (f"(CASE WHEN {name} = '' THEN NULL WHEN starts_with({name}, '#') THEN {_cp(number)} "
             f"ELSE (SELECT {names})[{name}] END)")
    value = value.replace(f"(SELECT {names})", f"({names})")
    one = f"(CASE WHEN {value} IS NULL THEN '&' || x ELSE {value} || substr(x, length({name}) + 2) END)"
    parts = f"string_split({e}, '&')"
    return f"({parts}[1] || array_to_string([{one} for x in {parts}[2:]], ''))"


def collapse_ws(e: str) -> str:
    return rx_replace(rx_replace(e, T.WS_RUN, " "), T.TRIM_WS, "")


def trim_ws(e: str) -> str:
    return rx_replace(e, T.TRIM_WS, "")


def inline_text(e: str) -> str:
    return collapse_ws(decode_entities(rx_replace(e, T.ANY_TAG, "")))


def word_count(e: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({e}, {q(T.NON_WS_RUN)})), 0) AS INTEGER)"


def normalize_markdown(e: str) -> str:
    t = f"replace(replace({e}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    t = rx_replace(t, r"\n{3,}", "\n\n")
    return rx_replace(t, T.TRIM_WS, "")


def go_quote(e: str) -> str:
    t = f"replace({e}, '\\', '\\\\')"
    t = f"replace({t}, '\"', '\\\"')"
    for code, esc in ((10, "\\n"), (13, "\\r"), (9, "\\t"), (7, "\\a"), (8, "\\b"), (12, "\\f"), (11, "\\v")):
        t = f"replace({t}, chr({code}), {q(esc)})"
    return f"'\"' || {t} || '\"'"


def rfc3339(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%dT%H:%M:%SZ')"


def _inside(e: str, opening: str, inside: str, rewrite) -> str:
    parts = f"string_split_regex({e}, {q(opening)})"
    body = rx_extract("x", inside, 1)
    one = f"({rewrite(body)} || substr(x, length({body}) + 1))"
    return f"({parts}[1] || array_to_string([{one} for x in {parts}[2:]], ''))"


def markdown_markup(e: str) -> str:
    out = _inside(e, OL_OPEN, OL_INSIDE, lambda b: f"chr(10) || chr(10) || {rx_replace(b, ITEM, chr(10) + '1. ')}")
    edge = "^(?:" + QUOTE_BREAK + r")|(?:" + QUOTE_BREAK + r")\z"
    out = _inside(out, QUOTE_OPEN, QUOTE_INSIDE, lambda b: "chr(10) || chr(10) || '> ' || " + rx_replace(
        rx_replace(b, edge, ""), QUOTE_BREAK, chr(10) + ">" + chr(10) + "> "))
    for pat, rep in MARKDOWN_RULES:
        out = rx_replace(out, pat, dollar_to_backslash(rep))
    return out


def attr_value(tag: str, attr_rx: str) -> str:
    return trim_ws(decode_entities(rx_replace(rx_extract(tag, attr_rx, 1), T.QUOTES, "")))


HEAD = r"(?is)<head\b[^>]*>(.*?)</head\s*>"


def extract_chain(source_sql: str, keep=("page_id",)) -> Chain:
    """E1 as CTEs over ``source_sql`` (which yields ``keep``, url, html)."""
    c = Chain(f"SELECT {', '.join(keep)}, url, html AS _html FROM ({source_sql})", "e")
    normalize_cols(c, "url", "norm_url")
    c.add({"_clean": rx_replace("coalesce(_html, '')", T.PRECLEAN, "")})
    c.add({
        "_head": rx_extract("_clean", HEAD, 1),
        "_art": rx_extract("_clean", T.ARTICLE_ELEM, 1),
        "_title_raw": rx_extract("_clean", T.TITLE, 1),
        "language": rx_extract("_clean", T.HTML_LANG, 1),
        "_byline_el": rx_extract("_clean", T.BYLINE_ELEM, 1),
    })
    c.add({"_headc": "CASE WHEN _head <> '' THEN _head ELSE _clean END"})
    c.add({
        "_m_author": rx_extract("_headc", T.meta_content_rx("name", "author"), 1),
        "_m_site": rx_extract("_headc", T.meta_content_rx("property", "og:site_name"), 1),
        "_canon_tag": rx_extract("_headc", T.CANONICAL_LINK, 1),
        "_main": f"CASE WHEN _art = '' THEN {rx_extract('_clean', T.MAIN_ELEM, 1)} ELSE '' END",
    })
    container = (f"CASE WHEN _art <> '' THEN {rx_replace('_art', T.OUTER_TAGS, '')} "
                 f"WHEN _main <> '' THEN {rx_replace('_main', T.OUTER_TAGS, '')} "
                 f"WHEN {rx_like('_clean', r'(?i)<body\b')} THEN {rx_extract('_clean', T.BODY_INNER, 1)} "
                 f"ELSE _clean END")
    c.add({"content_html": rx_replace(container, T.BOILERPLATE_BLOCKS, "")})
    markup = rx_replace(rx_replace("content_html", T.BLOCK_TAGS, "\n"), T.ANY_TAG, "")
    c.add({"_t1": markup, "_h1": rx_extract("content_html", T.H1, 1),
           "_p1": rx_extract("content_html", T.FIRST_P, 1), "_title": inline_text("_title_raw")})
    tidy = rx_replace(rx_replace(rx_replace(decode_entities("_t1"), T.HSPACE_RUN, " "), T.NL_RUN, "\n"), T.TRIM_WS, "")
    c.add({
        "text_content": tidy,
        "title": f"CASE WHEN _title <> '' THEN _title ELSE {inline_text('_h1')} END",
        "excerpt": inline_text("_p1"),
        "byline": f"CASE WHEN _m_author <> '' THEN {attr_value('_m_author', T.CONTENT_ATTR)} ELSE {inline_text('_byline_el')} END",
        "site_name": attr_value("_m_site", T.CONTENT_ATTR),
        "_canon_href": attr_value("_canon_tag", T.HREF_ATTR),
    })
    c.add({"word_count": word_count("text_content")})
    resolve_cols(c, "norm_url", "_canon_href", "_canon_abs")
    normalize_cols(c, "_canon_abs", "_canon_norm")
    c.add({"canonical_url": "CASE WHEN _canon_href <> '' THEN coalesce(_canon_norm, '') ELSE '' END"})
    return c


def markdown_expr(e: str) -> str:
    md1 = markdown_markup(e)
    return md1


def markdown_finish(md1: str) -> str:
    text = f"string_split({decode_entities(md1)}, {q(FENCE)})"
    loose = rx_replace(rx_replace("x", MD_HSPACE, " "), MD_LINE_EDGES, chr(10))
    return normalize_markdown(f"array_to_string(list_transform({text}, lambda x, i: CASE WHEN i % 2 = 0 THEN x ELSE {loose} END), {q(FENCE)})")
