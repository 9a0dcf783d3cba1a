"""Fixed values that must equal the behaviour being reproduced.

Everything in this module is a literal rule value (word lists, patterns,
defaults).  Keep them here, in natural order, so the rest of the library only
refers to names.
"""

# --- Fixed values: query keys removed during URL normalisation (exact key,
# compared after lowercasing the decoded key).
TRACKING_PARAMS = [
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "fbclid",
    "gclid",
]

# --- Fixed values: path substrings that mark a non-article page (matched
# against the lowercased, percent-decoded path).
BLACKLIST_SEGMENTS = [
    "/tag/",
    "/category/",
    "/author/",
    "/search",
    "/wp-login",
    "/wp-admin",
    "/wp-json",
    "/wp-content/",
    "/wp-includes/",
    "/feed",
    "/comments",
    "/attachment/",
    "/trackback/",
    "/replytocom",
    "/xmlrpc.php",
    "/wp-cron.php",
]

# --- Fixed values: unanchored patterns on the lowercased path that mark a
# likely article URL.
ARTICLE_PATTERNS = [
    r"/\d{4}/\d{2}/[^/]+",
    r"/blog/[^/]+",
    r"/news/[^/]+",
    r"/post/[^/]+",
    r"/articles?/[^/]+",
]

# --- Fixed values: job defaults.
DEFAULT_MAX_PAGES = 500
DEFAULT_MAX_DEPTH = 4
DEFAULT_DISCOVERY_MODE = "both"
DEFAULT_MIN_WORD_COUNT = 250
DISCOVERY_MODES = ["sitemap", "links", "both"]

# --- Fixed values: sitemap locations tried in order.
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml"]

# --- Fixed values: content types accepted as HTML (substring, lowercased).
HTML_CONTENT_TYPES = ["text/html", "application/xhtml+xml"]

# --- Fixed values: manifest CSV column order and the status constant.
MANIFEST_COLUMNS = [
    "url",
    "canonical_url",
    "relative_path",
    "title",
    "word_count",
    "content_hash",
    "crawled_at",
    "status",
]
MANIFEST_STATUS_OK = "ok"
EXTRACTION_METHOD = "readability"

# --- Fixed values: boilerplate phrases from the extraction-quality plan.
BOILERPLATE_PHRASES = [
    "related posts",
    "subscribe",
    "cookie",
    "share this",
    "leave a comment",
]

# --- Fixed values: Go's unicode.IsSpace set written as a regex character
# class body.  Java and RE2 both accept this spelling.
WS = r"\t\n\x0B\f\r\x{85}\p{Z}"
