"""Main text of web pages by a tree-structured graphical model over the DOM.

Nodes are block elements and the text runs between them; each is content or
boilerplate.  A node's potential is log-linear in its features (tag, cue words
in class, id and role, text length, link share, punctuation, place in the
tree); a parent-child potential couples each node with its parent, by the
child's kind.  Sum-product messages pass from the leaves to the root and back
and give exact marginals; runs with a content marginal of at least 0.5 are the
page's text, in page order.

Weights are the maximum likelihood on labelled pages (observed less expected
feature counts, both by the same messages).  Default training pages are
composed by rule from layouts with known labels (:func:`labelled_pages`); own
ones are HTML whose elements carry ``data-y="1"`` (content) or ``"0"``.  Fitting
takes a bounded number of pages (``TRAINING_PAGES``); every page of the table is
extracted whole, where it lies, with the few weights broadcast.

Defined results: null, empty and markup-only pages give empty text; a page of
bare text without any markup is one run; repeated rows are extracted row by
row; an empty table gives no rows.  Only page_id, url and html are read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices
from .dom import Tree, attributes, read

TRAINING_PAGES = 360
THRESHOLD = 0.5

#: Cue groups of class, id and role words: a word counts for a group if it begins with one of its cues.
CUES = {
    "advert": ("ad", "ads", "advert", "banner", "promo", "sponsor"),
    "navigation": ("nav", "menu", "breadcrumb", "crumb", "pager", "pagination", "toc", "tabs", "skip", "topbar"),
    "frame": ("header", "head", "masthead", "footer", "foot", "copyright", "legal", "colophon"),
    "side": ("side", "aside", "sidebar", "widget", "rail", "related", "recommend", "popular", "trending", "teaser", "more"),
    "notice": ("cookie", "consent", "notice", "alert", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "paywall", "disclaimer"),
    "social": ("share", "social", "follow", "comment", "comments", "reply", "respond", "disqus", "discussion", "feedback", "review"),
    "form": ("form", "search", "login", "contact"),
    "content": ("article", "content", "main", "post", "entry", "story", "text", "body", "prose", "page"),
    "meta": ("meta", "byline", "author", "date", "tags", "category"),
}
EXACT = frozenset(("ad", "ads", "head", "foot", "toc", "side", "more", "form", "text", "body", "page", "main", "date", "post", "reply", "review"))
TAGS = ("html body div section article main header footer nav aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure "
        "figcaption fieldset address menu button select textarea label dialog details summary center hgroup search").split()
KINDS = ("run", "paragraph", "heading", "item", "box", "frame")
_KIND = {"p": 1, "blockquote": 1, "pre": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "li": 3, "dt": 3, "dd": 3, "tr": 3, "td": 3, "th": 3,
         "nav": 5, "header": 5, "footer": 5, "aside": 5, "form": 5, "menu": 5, "dialog": 5}

_NAMES = ([f"tag {t}" for t in [*TAGS, "other", "run"]] + [f"cue {c}" for c in CUES] + [f"parent {t}" for t in [*TAGS, "other"]]
          + [f"{w} words {k}" for w in ("run", "box") for k in range(8)] + [f"{w} links {k}" for w in ("run", "box") for k in range(4)]
          + ["ends a sentence", "has a comma", "first half", "copyright", "bias"])
_FEATURE = {n: k for k, n in enumerate(_NAMES)}
_WORD = re.compile(r"[a-z]+")


@lru_cache(maxsize=50_000)
def _element(tag: str, attrs: str) -> tuple[int, ...]:
    found = [_FEATURE.get(f"tag {tag}", _FEATURE["tag other"]), _FEATURE["bias"]]
    if attrs:
        a = attributes(attrs)
        source = " ".join(re.sub(r"([a-z])([A-Z])", r"\1 \2", a.get(k, "")) for k in ("class", "id", "role", "aria-label")).lower()
        for w in set(_WORD.findall(source)):
            for name, cues in CUES.items():
                if any(w == c or c not in EXACT and w.startswith(c) for c in cues):
                    found.append(_FEATURE[f"cue {name}"])
    return tuple(dict.fromkeys(found))


def _steps(n: int) -> int:
    return min(7, n.bit_length())


def describe(tree: Tree) -> tuple[list[tuple[int, ...]], list[int]]:
    """Active features and kind of each node."""
    size = len(tree.parent)
    words, chars, linked = [0] * size, [0] * size, [0] * size
    for k in range(size - 1, -1, -1):  # children come after their parent
        if not tree.tag[k]:
            words[k], chars[k], linked[k] = tree.text[k].count(" ") + 1, len(tree.text[k]), tree.linked[k]
        if k:
            p = tree.parent[k]
            words[p] += words[k]
            chars[p] += chars[k]
            linked[p] += linked[k]
    out, kinds = [], []
    for k in range(size):
        tag = tree.tag[k]
        share = 4 * linked[k] // (chars[k] + 1)
        what = "box" if tag else "run"
        if tag:
            found = list(_element(tag, tree.attrs[k]))
        else:
            text = tree.text[k]
            found = [_FEATURE["tag run"], _FEATURE["bias"]]
            if text[-1] in ".!?…\"”":
                found.append(_FEATURE["ends a sentence"])
            if ", " in text:
                found.append(_FEATURE["has a comma"])
            if "©" in text:
                found.append(_FEATURE["copyright"])
        if k:
            above = tree.tag[tree.parent[k]]
            found.append(_FEATURE.get(f"parent {above}", _FEATURE["parent other"]))
        found.append(_FEATURE[f"{what} words {_steps(words[k])}"])
        found.append(_FEATURE[f"{what} links {min(3, share)}"])
        if 2 * k < size:
            found.append(_FEATURE["first half"])
        out.append(tuple(found))
        kinds.append(_KIND.get(tag, 4) if tag else 0)
    return out, kinds


class Forest:
    """The trees of a batch of pages in arrays, dealt by depth."""

    def __init__(self, pages: list[str | None]) -> None:
        trees = [read(h) for h in pages]
        parent, kinds, flat, starts, self.text, self.page, self.label = [], [], [], [], [], [], []
        depth: list[int] = []
        used = 0
        for number, tree in enumerate(trees):
            base = len(parent)
            found, kind = describe(tree)
            kinds += kind
            for k, f in enumerate(found):
                starts.append(used)
                flat += f
                used += len(f)
                up = tree.parent[k]
                parent.append(base + up if up >= 0 else -1)
                depth.append(depth[base + up] + 1 if up >= 0 else 0)
            self.text += tree.text
            self.page += [number] * len(tree.parent)
            self.trees = trees
        self.pages = len(pages)
        self.parent, self.kind = np.array(parent, np.int64), np.array(kinds, np.int64)
        self.flat, self.starts = np.array(flat, np.int64), np.array(starts, np.int64)
        order = np.argsort(np.array(depth, np.int64), kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(np.array(depth, np.int64)[order])) + 1)[1:] if len(order) else []  # without the roots

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node, and each node's joint with its parent [node, parent's state, own state]."""
        score = np.zeros((len(self.parent), 2))
        score[:, 1] = np.add.reduceat(unary[self.flat], self.starts) if len(self.starts) else 0
        up = score.copy()  # a node's own score and what came from below
        message = np.zeros_like(up)  # from a node to its parent
        for level in reversed(self.levels):
            joint = up[level][:, None, :] + pair[self.kind[level]]
            message[level] = np.logaddexp(joint[..., 0], joint[..., 1])
            np.add.at(up, self.parent[level], message[level])
        belief = up.copy()
        both = np.zeros((len(self.parent), 2, 2))
        for level in self.levels:
            above = belief[self.parent[level]] - message[level]  # all that the parent knows but from here
            joint = above[:, :, None] + pair[self.kind[level]] + up[level][:, None, :]
            belief[level] = np.logaddexp(joint[:, 0], joint[:, 1])
            both[level] = np.exp(joint - np.logaddexp.reduce(joint.reshape(len(level), 4), axis=1)[:, None, None])
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), both


def _labels(tree: Tree) -> list[int]:
    out: list[int] = []
    for k in range(len(tree.parent)):
        mark = attributes(tree.attrs[k]).get("data-y") if tree.attrs[k] else None
        out.append(int(mark) if mark in ("0", "1") else out[tree.parent[k]] if k else 0)
    return out


def train(pages: list[str], steps: int = 220, rate: float = 0.2, penalty: float = 0.003) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features and of (kind, parent's state, own state), by gradient ascent on the likelihood (Adam)."""
    forest = Forest(pages)
    y = np.concatenate([_labels(t) for t in forest.trees])
    each = np.diff(np.append(forest.starts, len(forest.flat)))
    owner = np.repeat(np.arange(len(y)), each)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(KINDS), 2, 2))
    np.add.at(seen, (forest.kind[child], y[forest.parent[child]], y[child]), 1)
    theta = np.zeros(len(_NAMES) + seen.size)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        unary, pair = theta[:len(_NAMES)], theta[len(_NAMES):].reshape(seen.shape)
        p, both = forest.marginals(unary, pair)
        expected = np.zeros_like(seen)
        np.add.at(expected, forest.kind[child], both[child])
        slope = np.concatenate([np.bincount(forest.flat, (y - p)[owner], len(_NAMES)), (seen - expected).ravel()]) / forest.pages - penalty * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return theta[:len(_NAMES)], theta[len(_NAMES):].reshape(seen.shape)


def extract(pages: list[str | None], weights: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> list[str]:
    forest = Forest(pages)
    p, _ = forest.marginals(*weights)
    out: list[list[str]] = [[] for _ in pages]
    for k in np.flatnonzero((p >= threshold) & (forest.kind == 0)).tolist():
        if forest.text[k]:
            out[forest.page[k]].append(forest.text[k])
    return ["\n".join(x) for x in out]


# ---- training pages -------------------------------------------------------

def _prose(r: random.Random, low: int, high: int) -> str:
    def word() -> str:
        return "".join(r.choice(("an", "er", "in", "th", "on", "es", "re", "ti", "ou", "at", "é", "ü", "ch")) for _ in range(r.randint(1, 4)))
    out, n = [], r.randint(low, high)
    while n > 0:
        k = min(n, r.randint(3, 18))
        s = [word() for _ in range(k)]
        if k > 5:
            s[k // 2] += ","
        out.append(" ".join(s).capitalize() + r.choice("....!?"))
        n -= k
    return " ".join(out)


def _label(r: random.Random) -> str:
    return _prose(r, 1, 4).rstrip(".!?")


def _links(r: random.Random, tag: str = "li", n: int | None = None) -> str:
    one = [f'<a href="/{k}">{_label(r)}</a>' for k in range(n or r.randint(2, 9))]
    return "".join(f"<{tag}>{x}</{tag}>" for x in one) if tag else r.choice((" | ", " ", " · ")).join(one)


def _list(r: random.Random) -> str:
    return f"<ul>{_links(r)}</ul>"


def _box(r: random.Random, names: tuple[str, ...], inner: str, tags: tuple[str, ...] = ("div", "div", "section")) -> str:
    tag, key = r.choice(tags), r.choice(("class", "class", "id"))
    return f'<{tag} {key}="{r.choice(names)}" data-y="0">{inner}</{tag}>'


def _paragraphs(r: random.Random, low: int = 1, high: int = 4, words: tuple[int, int] = (4, 70)) -> str:
    return "".join(f"<p>{_prose(r, *words)}" + r.choice(("</p>", "</p>", "")) for _ in range(r.randint(low, high)))


def _noise(r: random.Random) -> str:
    """One block of boilerplate, labelled."""
    return r.choice((
        lambda: _box(r, ("ad", "ads", "advert", "ad-slot", "banner", "sponsored", "promo-box"), r.choice((_prose(r, 2, 30), _paragraphs(r, 1, 2, (2, 25))))),
        lambda: f'<nav data-y="0">{_list(r)}</nav>',
        lambda: _box(r, ("menu", "navbar", "breadcrumbs", "pagination", "nav-links"), r.choice((_list(r), _links(r, "")))),
        lambda: f'<aside data-y="0"><h3>{_label(r)}</h3>{r.choice((_list(r), _paragraphs(r, 1, 2, (3, 30))))}</aside>',
        lambda: _box(r, ("sidebar", "widget", "related", "related-posts", "recommended", "most-popular", "teasers"),
                     f"<h3>{_label(r)}</h3>" + r.choice((_list(r), _paragraphs(r, 1, 3, (5, 30))))),
        lambda: _box(r, ("cookie-notice", "cookie-banner", "consent", "notice", "alert", "newsletter", "subscribe-box", "gdpr", "popup"),
                     r.choice((_prose(r, 5, 40), _paragraphs(r, 1, 2, (5, 40)))) + r.choice(("", f"<button>{_label(r)}</button>"))),
        lambda: _box(r, ("comments", "comment-list", "reader-comments", "disqus_thread", "responses comments"),
                     f"<h2>{_label(r)}</h2>" + "".join(f'<div class="comment"><b>{_label(r)}</b>{_paragraphs(r, 1, 2, (4, 60))}</div>' for _ in range(r.randint(1, 4)))),
        lambda: f'<form data-y="0"><label>{_label(r)}</label><input name="q"><select><option>{_label(r)}<option>{_label(r)}</select>'
                f'<textarea>{_label(r)}</textarea><button>{_label(r)}</button><p>{_prose(r, 2, 20)}</p></form>',
        lambda: _box(r, ("share", "social-links", "share-buttons", "follow-us"), _links(r, r.choice(("li", "span", "")))),
        lambda: f'<script data-y="0">var x = "<p>";</script><style>p {{ margin: 0 }}</style><!-- <p>{_label(r)}</p> -->',
    ))()


def _article(r: random.Random) -> str:
    """The inside of an article, with boilerplate among it."""
    title = _prose(r, 2, 12).rstrip(".")
    parts = [f"<{(h := r.choice(('h1', 'h1', 'h2')))}>{title}</{h}>"]
    if r.random() < 0.4:
        parts.append(f"<p><b>{_prose(r, 1, 40)}<br>")
    for _ in range(r.choice((0, 1, 1, 2, 3, 4, 5, 7, 9))):
        parts.append(r.choice((
            lambda: _paragraphs(r, 1, 3, (1, 12)), lambda: _paragraphs(r), lambda: _paragraphs(r, 1, 3, (30, 150)),
            lambda: f"<p>{_prose(r, 5, 30)} <a href='/x'>{_label(r)}</a> {_prose(r, 3, 30)}</p>",
            lambda: f"<h2>{_label(r)}</h2>{_paragraphs(r, 1, 2)}", lambda: f"<h3>{_label(r)}</h3>{_paragraphs(r, 1, 2)}",
            lambda: "<ul>" + "".join(f"<li>{_prose(r, 2, 25)}</li>" for _ in range(r.randint(2, 5))) + "</ul>",
            lambda: "<ol>" + "".join(f"<li>{_prose(r, 2, 25)}" for _ in range(r.randint(2, 5))) + "</ol>",
            lambda: f"<blockquote>{r.choice((_prose(r, 5, 40), _paragraphs(r, 1, 2)))}</blockquote>", lambda: f"<pre>{_prose(r, 4, 30)}</pre>",
            lambda: f"<figure><img src='x.png'><figcaption>{_prose(r, 3, 15)}</figcaption></figure>",
            lambda: "<table>" + "".join(f"<tr><th>{_label(r)}<td>{_label(r)}</tr>" for _ in range(r.randint(1, 4))) + "</table>",
            lambda: f"<div>{_prose(r, 5, 60)}</div>",
            lambda: "".join(f"<p>{_label(r)}{r.choice(('', '.'))}</p>" for _ in range(r.randint(8, 50))),
        ))())
    for _ in range(r.choice((0, 0, 0, 1, 2))):
        parts.insert(r.randint(1, len(parts)), _noise(r))
    return "".join(parts)


def labelled_page(r: random.Random) -> str:
    """A page of a random layout; elements carry their label in ``data-y``."""
    body = _article(r)
    if (layout := r.random()) < 0.55:
        main = f'<article data-y="1">{body}</article>'
    elif layout < 0.7:
        main = f'<main data-y="1">{body}</main>'
    else:
        name = r.choice(("content", "article-body", "post-content", "entry", "story", "main-text", "post"))
        main = f'<div {r.choice(("class", "id"))}="{name}" data-y="1">{body}</div>'
    if r.random() < 0.4:
        main = f'<{(w := r.choice(("div", "main", "section")))} data-y="1">{main}{_noise(r) if r.random() < 0.4 else ""}</{w}>'
    before = [_noise(r) for _ in range(r.randint(0, 3))]
    if r.random() < 0.5:
        inner = r.choice((f"<h1>{_label(r)}</h1>{_list(r)}", f"<div>{_label(r)}</div><p>{_prose(r, 2, 15)}</p>", _links(r, "")))
        before.insert(0, f'<header data-y="0">{inner}</header>' if r.random() < 0.7 else _box(r, ("header", "masthead", "site-header"), inner))
    after = [_noise(r) for _ in range(r.randint(0, 3))]
    if r.random() < 0.8:
        inner = r.choice((f"&copy; {_label(r)} &middot; {_prose(r, 2, 25)}", _paragraphs(r, 1, 2, (2, 25)), _list(r)))
        after.append(f'<footer data-y="0">{inner}</footer>' if r.random() < 0.7 else _box(r, ("footer", "copyright", "site-footer"), inner))
    html = "".join((*before, main, *after))
    return f"<!DOCTYPE html><html><head><title>{_label(r)}</title></head><body>{html}</body></html>"


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 7) -> list[str]:
    r = random.Random(seed)
    return [labelled_page(r) for _ in range(n)]


def extract_text(pages: DataFrame, weights: tuple[np.ndarray, np.ndarray] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""
    sent = pages.sparkSession.sparkContext.broadcast(weights or train(labelled_pages()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=256):
            texts = extract(part.column(2).to_pylist(), sent.value, threshold)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
