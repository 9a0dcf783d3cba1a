"""URL functions: DataFrame transforms built from JVM expressions only.

URL syntax follows Go's ``net/url`` parser as far as page URLs need it: the
string is split with the RFC 3986 appendix-B pattern, then checked for the
cases Go rejects (control bytes, bad scheme, colon in a first relative
segment, bad port, bad host byte, bad percent escape).  ``parse_url`` is not
used: it returns null for a space or ``|`` in the path, which Go accepts.

Parts are materialised as named columns in successive projections, so each
regex runs once per row: Catalyst does not inline a non-cheap expression that
is referenced more than once.  Helpers that take a ``Column`` expect a plain
column reference when they use it more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfold.constants import ARTICLE_PATTERNS, BLACKLIST_SEGMENTS, TRACKING_PARAMS

# RFC 3986 appendix B.  Groups: 2 scheme, 3 "//authority", 4 authority,
# 5 path, 6 "?query", 7 query, 8 "#fragment", 9 fragment.
RFC3986 = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"
_RFC3986_DOTALL = "(?s)" + RFC3986

CTL = r"[\x00-\x1f\x7f]"
SCHEME_OK = r"^[A-Za-z][A-Za-z0-9+.\-]*$"
# A '%' not followed by two hex digits (no look-ahead, so RE2 accepts it too).
BAD_ESCAPE = r"%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)"
# Bytes below 0x80 that Go refuses inside a host.
BAD_HOST_CHAR = r"[ %\\^`{|}]"
# A port must be digits: something non-digit after the last ':' is an error.
BAD_PORT = r":[^:]*[^0-9:][^:]*$"
# Characters that may stay unescaped in an already-encoded path.
PATH_VALID_ENCODED = r"^[A-Za-z0-9\-_.~!$&'()*+,;=:@\[\]%/]*$"

_BLACKLIST_RX = "|".join(s.replace(".", r"\.") for s in BLACKLIST_SEGMENTS)
_ARTICLE_RX = "|".join(ARTICLE_PATTERNS)


# ---------------------------------------------------------------- column helpers

def stop_pushdown(c: Column) -> Column:
    """Mark the projection holding ``c`` non-deterministic.

    Catalyst pushes a filter through a deterministic projection by inlining
    the filtered columns' definitions; over the stacked projections of URL
    parsing that inlining grows exponentially (and would also re-run the
    regexes).  A projection with a non-deterministic expression stops the
    filter right above it.  Filters on the *input* columns belong before
    these transforms, where they still reach the scan.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def query_escape(s: Column) -> Column:
    """Go ``url.QueryEscape``: space as '+', keep ``-_.~``, escape the rest."""
    enc = F.url_encode(s)  # Java URLEncoder keeps .-*_ and escapes ~
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def path_escape(s: Column) -> Column:
    """Go path escaping: keep alnum, ``-_.~`` and ``$&+,/:;=@``; space as %20."""
    enc = F.url_encode(s)
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    for code, ch in (
        ("%7E", "~"), ("%2F", "/"), ("%24", "$"), ("%26", "&"), ("%2B", "+"),
        ("%2C", ","), ("%3A", ":"), ("%3B", ";"), ("%3D", "="), ("%40", "@"),
    ):
        enc = F.replace(enc, F.lit(code), F.lit(ch))
    return enc


def decode_path(path: Column) -> Column:
    """Percent-decode a path; unlike a query, '+' stays '+'."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def canonical_query(query: Column) -> Column:
    """Decode pairs, drop tracking keys, sort by key then value, re-encode.

    Empty pairs, pairs containing ';' and pairs with a bad escape are dropped
    (Go's ``ParseQuery`` skips them).  Returns '' when nothing is left.
    """
    pairs = F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.contains(";"))
    kv = F.transform(
        pairs,
        lambda p: F.struct(
            F.regexp_extract(p, r"^([^=]*)", 1).alias("k"),
            F.when(p.contains("="), F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1))
            .otherwise(F.lit(""))
            .alias("v"),
        ),
    )
    kv = F.filter(kv, lambda x: ~x["k"].rlike(BAD_ESCAPE) & ~x["v"].rlike(BAD_ESCAPE))
    dec = F.transform(
        kv,
        lambda x: F.struct(F.try_url_decode(x["k"]).alias("k"), F.try_url_decode(x["v"]).alias("v")),
    )
    kept = F.filter(
        dec,
        lambda x: x["k"].isNotNull() & x["v"].isNotNull() & ~F.lower(x["k"]).isin(*TRACKING_PARAMS),
    )
    encoded = F.transform(
        F.array_sort(kept),
        lambda x: F.concat(query_escape(x["k"]), F.lit("="), query_escape(x["v"])),
    )
    return F.array_join(encoded, "&")


def allowed_domains(domain: Column) -> Column:
    """U4: ``[d, 'www.' + d]`` with d lowercased, trimmed and without 'www.'."""
    d = F.regexp_replace(F.lower(F.trim(domain)), r"^www\.", "")
    return F.array(d, F.concat(F.lit("www."), d))


def domain_of_host(host: Column) -> Column:
    """Job key of a host: lowercase, without a leading 'www.'."""
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def is_blacklisted_path(path: Column) -> Column:
    """lowercase decoded path contains one of the blacklisted segments."""
    return F.lower(path).rlike(_BLACKLIST_RX)


def is_article_path(path: Column) -> Column:
    """lowercase decoded path matches one of the article patterns."""
    return F.lower(path).rlike(_ARTICLE_RX)


def short_hash(s: Column) -> Column:
    """First 6 hex characters of SHA-256."""
    return F.substring(F.sha2(s, 256), 1, 6)


def remove_dot_segments(full: Column) -> Column:
    """Go ``resolvePath`` dot-segment folding; result starts with '/'."""
    elems = F.split(full, "/", -1)
    folded = F.aggregate(
        elems,
        F.array().cast("array<string>"),
        lambda acc, e: F.when(e == ".", acc)
        .when(e == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(e))),
    )
    r = F.concat(
        F.lit("/"),
        F.array_join(folded, "/"),
        F.when(F.element_at(elems, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit("")),
    )
    out = F.when(r.startswith("//"), F.substring(r, 2, 1 << 30)).otherwise(r)
    return F.when(full == "", F.lit("")).otherwise(out)


def clean_join(prefix: Column, rel: Column, floor: int) -> Column:
    """Join path segments under ``prefix``: drop '' and '.', fold '..' but never
    above the first ``floor`` segments (a page must not leave its host's folder)."""
    segs = F.concat(prefix, F.split(rel, "/", -1))
    folded = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when((s == "") | (s == "."), acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(floor))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.array_join(folded, "/")


# ---------------------------------------------------------------- DataFrame transforms

def parse_urls(df: DataFrame, src: str, p: str) -> DataFrame:
    """Add parsed parts of column ``src`` under prefix ``p``.

    Adds ``{p}_ok`` (parses), ``{p}_has_scheme``, ``{p}_scheme`` (lowercase),
    ``{p}_has_auth``, ``{p}_userinfo``, ``{p}_hostport``, ``{p}_host`` (lowercase,
    no port), ``{p}_rawpath`` (as written), ``{p}_path`` (decoded, '' for an
    opaque URL), ``{p}_opaque``, ``{p}_has_query``, ``{p}_query`` (raw).
    """
    c = F.col(src)
    # one match: the groups in one string, split again (the fragment last, as it may hold the separator)
    groups = "\x01".join(f"${{{i}}}".replace("{", "").replace("}", "") for i in (1, 2, 3, 4, 5, 6, 7, 9))
    df = df.withColumn(f"{p}_m", F.split(F.regexp_replace(c, _RFC3986_DOTALL, groups), "\x01", 8))
    df = df.withColumns({f"{p}_g{i}": F.get(f"{p}_m", F.lit(k)) for k, i in enumerate((1, 2, 3, 4, 5, 6, 7, 9))})
    hs, sch, ha, auth, path = (F.col(f"{p}_g1") != ""), F.col(f"{p}_g2"), (F.col(f"{p}_g3") != ""), F.col(f"{p}_g4"), F.col(f"{p}_g5")
    # a scheme-less "///x" (or "//") is a path, not an empty authority
    no_auth = ~hs & ha & (auth == "")
    df = df.withColumns({
        f"{p}_has_scheme": hs,
        f"{p}_scheme": F.lower(sch),
        f"{p}_has_auth": ha & ~no_auth,
        f"{p}_rawpath": F.when(no_auth, F.concat(F.lit("//"), path)).otherwise(path),
        f"{p}_userinfo": F.regexp_extract(auth, r"^(.*@)?[^@]*$", 1),
        f"{p}_hostport": F.regexp_extract(auth, r"^(?:.*@)?([^@]*)$", 1),
        f"{p}_has_query": F.col(f"{p}_g6") != "",
        f"{p}_query": F.col(f"{p}_g7"),
    })
    hp, rp = F.col(f"{p}_hostport"), F.col(f"{p}_rawpath")
    first_seg = F.regexp_extract(rp, r"^([^/]*)", 1)
    port_ok = hp.startswith("[") | ~hp.rlike(BAD_PORT)
    ok = (
        c.isNotNull()
        & ~c.rlike("^[^#]*" + CTL)
        & (~F.col(f"{p}_has_scheme") | sch.rlike(SCHEME_OK))
        & ~(~F.col(f"{p}_has_scheme") & ~rp.startswith("/") & first_seg.contains(":"))
        & (~F.col(f"{p}_has_auth") | (port_ok & ~hp.rlike(BAD_HOST_CHAR)))
        & ~rp.rlike(BAD_ESCAPE)
        & ~F.col(f"{p}_g9").rlike(BAD_ESCAPE)
    )
    opaque = F.col(f"{p}_has_scheme") & ~rp.startswith("/") & ~F.col(f"{p}_has_auth")
    hostname = F.when(
        F.col(f"{p}_has_auth"),
        F.lower(
            F.when(hp.startswith("["), F.regexp_extract(hp, r"^\[([^\]]*)\]", 1))
            .otherwise(F.regexp_replace(hp, r":[^:]*$", ""))
        ),
    ).otherwise(F.lit(""))
    df = df.withColumns({
        f"{p}_ok": stop_pushdown(F.coalesce(ok, F.lit(False))),
        f"{p}_opaque": opaque,
        f"{p}_host": hostname,
        f"{p}_path": F.when(opaque, F.lit("")).otherwise(decode_path(rp)),
    })
    return df.drop(*[f"{p}_g{i}" for i in (1, 2, 3, 4, 5, 6, 7, 9)], f"{p}_m")


def url_part_columns(p: str) -> list[str]:
    return [f"{p}_{s}" for s in ("ok", "has_scheme", "scheme", "has_auth", "userinfo", "hostport",
                                 "host", "rawpath", "path", "opaque", "has_query", "query")]


def _assemble_normalized(p: str) -> Column:
    rp, dec = F.col(f"{p}_rawpath"), F.col(f"{p}_path")
    trimmed = (F.length(dec) > 1) & dec.endswith("/")
    out_path = (
        F.when(trimmed, path_escape(F.regexp_replace(dec, "/+$", "")))
        .when(rp.rlike(PATH_VALID_ENCODED), rp)
        .otherwise(path_escape(dec))
    )
    cq = F.col(f"{p}_cq")
    query_part = (
        F.when(F.col(f"{p}_has_query") & (F.col(f"{p}_query") == ""), F.lit("?"))
        .when(F.col(f"{p}_has_query") & (cq != ""), F.concat(F.lit("?"), cq))
        .otherwise(F.lit(""))
    )
    hostport, userinfo = F.lower(F.col(f"{p}_hostport")), F.col(f"{p}_userinfo")
    auth_part = F.when(
        F.col(f"{p}_has_auth") & ((hostport != "") | (rp != "") | (userinfo != "")),
        F.concat(F.lit("//"), userinfo, hostport),
    ).otherwise(F.lit(""))
    body = F.when(F.col(f"{p}_opaque"), rp).otherwise(F.concat(auth_part, out_path))
    norm = F.concat(
        F.when(F.col(f"{p}_has_scheme"), F.concat(F.col(f"{p}_scheme"), F.lit(":"))).otherwise(F.lit("")),
        body,
        query_part,
    )
    return F.when(F.col(f"{p}_ok"), norm)


def normalize_urls(df: DataFrame, src: str = "url", out: str = "norm_url", keep_parts: str | None = None) -> DataFrame:
    """Add ``out`` = canonical URL of ``src`` (null when it does not parse).

    Lowercases scheme and host, drops the fragment, removes the tracking keys,
    sorts the remaining query pairs and strips every trailing '/' from a
    non-root path.  Default ports are kept.  With ``keep_parts`` the parsed
    parts of ``src`` stay under that prefix.
    """
    p = keep_parts or f"_{out}"
    df = parse_urls(df, src, p)
    df = df.withColumn(f"{p}_cq", canonical_query(F.col(f"{p}_query")))
    df = df.withColumn(out, stop_pushdown(_assemble_normalized(p)))
    drop = [f"{p}_cq"] + ([] if keep_parts else url_part_columns(p))
    return df.drop(*drop)


def relative_paths(df: DataFrame, norm: str = "norm_url", out: str = "relative_path") -> DataFrame:
    """``pages/<host>/<path>.md`` from an already normalised URL column.

    Root → ``index``; ``.html`` then ``.htm`` stripped; ``--<hash6>`` of the
    normalised URL added when it has a query or an extension was stripped;
    path cleaned like ``filepath.Join``.  Null without a host.
    """
    p = f"_{out}"
    df = parse_urls(df, norm, p)
    original = F.regexp_replace(F.col(f"{p}_path"), r"^/+|/+$", "")
    df = df.withColumn(f"{p}_orig", original)
    o = F.col(f"{p}_orig")
    p0 = F.when(o == "", F.lit("index")).otherwise(o)
    stripped = F.regexp_replace(F.regexp_replace(p0, r"\.html$", ""), r"\.htm$", "")
    df = df.withColumn(f"{p}_clean", F.when(stripped == "", F.lit("index")).otherwise(stripped))
    cl = F.col(f"{p}_clean")
    base = clean_join(F.array(F.lit("pages"), F.col(f"{p}_host")), cl, floor=2)
    lossy = (F.col(f"{p}_query") != "") | ((o != "") & (cl != o))
    rel = F.when(lossy, F.concat(base, F.lit("--"), short_hash(F.col(norm)), F.lit(".md"))).otherwise(
        F.concat(base, F.lit(".md"))
    )
    df = df.withColumn(out, stop_pushdown(F.when(F.col(norm).isNotNull() & (F.col(f"{p}_host") != ""), rel)))
    return df.drop(*url_part_columns(p), f"{p}_orig", f"{p}_clean")


def url_filters(df: DataFrame, src: str, domains: str | None = None, prefix: str = "") -> DataFrame:
    """F1-F4 flags on URL column ``src``: ``{prefix}host``, ``in_scope``,
    ``blacklisted``, ``allowed``, ``likely_article``.  ``domains`` names an
    array<string> column of allowed hosts (F1 is skipped without it)."""
    p = f"_{prefix}f"
    df = parse_urls(df, src, p)
    ok, host, path = F.col(f"{p}_ok"), F.col(f"{p}_host"), F.col(f"{p}_path")
    cols = {
        f"{prefix}host": F.when(ok, host),
        f"{prefix}blacklisted": F.coalesce(ok & is_blacklisted_path(path), F.lit(False)),
        f"{prefix}likely_article": F.coalesce(ok & is_article_path(path), F.lit(False)),
    }
    if domains:
        in_scope = F.coalesce(ok & F.array_contains(F.col(domains), host), F.lit(False))
        cols[f"{prefix}in_scope"] = in_scope
        cols[f"{prefix}allowed"] = F.coalesce(
            ok & F.array_contains(F.col(domains), host) & ~is_blacklisted_path(path), F.lit(False)
        )
    df = df.withColumns(cols)
    return df.drop(*url_part_columns(p))


def resolve_urls(df: DataFrame, base: str, ref: str, out: str, base_parts: str | None = None) -> DataFrame:
    """U8: resolve column ``ref`` against column ``base`` (RFC 3986 §5.2, as
    Go ``ResolveReference``).  A ref starting with '#' or an unparseable side
    gives null.  The result is not normalised; run :func:`normalize_urls`.
    ``base_parts`` names the prefix of a base that :func:`parse_urls` has read
    already (:data:`BASE_PARTS`): many links of a page share one parse."""
    b, r = base_parts or f"_{out}_b", f"_{out}_r"
    df = parse_urls(df if base_parts else parse_urls(df, base, b), ref, r)
    rp, bp = F.col(f"{r}_rawpath"), F.col(f"{b}_rawpath")

    def q(x):
        return F.when(F.col(f"{x}_has_query"), F.concat(F.lit("?"), F.col(f"{x}_query"))).otherwise(F.lit(""))

    merged = (
        F.when(rp.startswith("/"), rp)
        .when(F.col(f"{b}_has_auth") & (bp == ""), F.concat(F.lit("/"), rp))
        .otherwise(F.concat(F.regexp_extract(bp, r"^(.*/)?[^/]*$", 1), rp))
    )
    df = df.withColumn(f"{out}_m", F.when(F.col(f"{r}_has_scheme") | F.col(f"{r}_has_auth"), rp)
                       .when(rp == "", bp).otherwise(merged))
    m = F.col(f"{out}_m")
    scheme = F.when(F.col(f"{r}_has_scheme"), F.col(f"{r}_scheme")).otherwise(F.col(f"{b}_scheme"))
    scheme_part = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit(""))
    path = F.when(F.col(f"{r}_opaque"), rp).otherwise(remove_dot_segments(m))
    absolute = F.concat(
        scheme_part,
        F.when(F.col(f"{r}_has_auth"), F.concat(F.lit("//"), F.col(f"{r}_userinfo"), F.col(f"{r}_hostport"))).otherwise(F.lit("")),
        path,
        q(r),
    )
    from_base = F.concat(
        scheme_part,
        F.when(F.col(f"{b}_has_auth"), F.concat(F.lit("//"), F.col(f"{b}_userinfo"), F.col(f"{b}_hostport"))).otherwise(F.lit("")),
        path,
        F.when((rp == "") & ~F.col(f"{r}_has_query"), q(b)).otherwise(q(r)),
    )
    res = F.when(F.col(f"{r}_has_scheme") | F.col(f"{r}_has_auth"), absolute).otherwise(from_base)
    ok = ~F.col(ref).startswith("#") & F.col(f"{b}_ok") & F.col(f"{r}_ok")
    df = df.withColumn(out, stop_pushdown(F.when(ok, res)))
    return df.drop(*url_part_columns(b), *url_part_columns(r), f"{out}_m")


#: The parts of a base URL that a reference is resolved with.
BASE_PARTS = ("ok", "scheme", "has_auth", "userinfo", "hostport", "rawpath", "has_query", "query")
