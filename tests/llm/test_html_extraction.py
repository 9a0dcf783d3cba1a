import random

import numpy as np
import pytest

from webfold.llm import html_extraction as X
from webfold.llm.dom import read


@pytest.fixture(scope="module")
def weights():
    return X.train(X.labelled_pages())


def runs(html):
    t = read(html)
    return [x for x, tag in zip(t.text, t.tag) if not tag]


def test_reader_blocks_and_text():
    assert runs("<p>a  b<br>c\n d</p>e<div>f</div>") == ["a b c d", "e", "f"]
    assert runs("<p>one<p>two<ul><li>x<li>y</ul>z") == ["one", "two", "x", "y", "z"]
    assert runs("&lt;p&gt; &amp;amp; &eacute; &#233; &#xE9; &am &nbsp;x") == ["<p> &amp; é é é &am x"]
    assert runs("<SCRIPT>var a='<p>no</p>'</script >yes<style>p{}") == ["yes"]
    assert runs("a<!-- <p>no --> b<![CDATA[ c ]]>") == ["a b c"]
    assert runs("<p title='a>b' data-x=\"<p>\">in</p>") == ["in"]
    assert runs("1 < 2 and <b>bold</i> 3 > 2</b>") == ["1 < 2 and bold 3 > 2"]
    assert runs("<article><p><b>open<br><p>next</article><footer>f</footer>") == ["open", "next", "f"]
    assert runs("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert runs(None) == runs("") == runs("<div><p></p></div>") == []


def brute_marginals(parent, kind, score, pair):
    n = len(parent)
    total, on = 0.0, np.zeros(n)
    for code in range(1 << n):
        x = [code >> k & 1 for k in range(n)]
        s = np.exp(sum(score[k] * x[k] for k in range(n)) + sum(pair[kind[k]][x[parent[k]]][x[k]] for k in range(n) if parent[k] >= 0))
        total += s
        on += s * np.array(x)
    return on / total


def test_messages_give_exact_marginals():
    r, rng = random.Random(5), np.random.default_rng(5)
    unary, pair = rng.normal(size=len(X._NAMES)), rng.normal(size=(len(X.KINDS), 2, 2))
    pages = ["<div><p>a, b</p><nav><a>c</a></nav></div>", "x<article><h1>t</h1><p>u</p></article>", "", X._noise(r)[:150]]
    forest = X.Forest(pages)
    p, _ = forest.marginals(unary, pair)
    score = np.add.reduceat(unary[forest.flat], forest.starts)
    for page in range(len(pages)):
        at = np.flatnonzero(np.array(forest.page) == page)
        base = at[0]
        want = brute_marginals([q - base if q >= 0 else -1 for q in forest.parent[at]], forest.kind[at], score[at], pair)
        assert np.allclose(p[at], want)


def test_held_out_labelled_pages(weights):
    r = random.Random(12345)
    forest = X.Forest([X.labelled_page(r) for _ in range(200)])
    p, _ = forest.marginals(*weights)
    y = np.concatenate([X._labels(t) for t in forest.trees])
    run = forest.kind == 0
    assert ((p[run] >= 0.5) == (y[run] == 1)).mean() > 0.99


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><h1>Site name</h1><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></header>
<div class="cookie-banner"><p>We use cookies to improve your visit.</p><button>OK</button></div>
<article><h1>The title &amp; more</h1><p>First   paragraph, of some length, with
a line break and <a href="/x">a link</a> in it.</p><div class="advert">Buy now, buy cheap.</div><p>Second paragraph, which is somewhat longer than the first.
<blockquote>Quoted words, as they were said.</blockquote><ul><li>A point of the list, made well.<li>Another point of the list.</ul></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this article very much, thanks for it.</p></div></section>
<aside><h3>Related</h3><ul><li><a href="/a">Other story</a></li></ul></aside><form><label>Search</label><input></form>
<footer>&copy; 2024 Site name &middot; All rights reserved.</footer><script>track("<p>")</script></body></html>"""


def test_a_page_with_all_kinds_of_blocks(weights):
    assert X.extract([PAGE], weights) == ["The title & more\nFirst paragraph, of some length, with a line break and a link in it.\nSecond paragraph, which is somewhat "
                                          "longer than the first.\nQuoted words, as they were said.\nA point of the list, made well.\nAnother point of the list."]


def test_odd_pages_in_spark(spark, weights):
    data = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<script>x</script>"), (4, "u", "<article><p>" + "Long text, indeed. " * 50_000 + "</p></article>"),
            (5, "u", "<div>" * 3000 + "deep")]
    from pyspark.sql import functions as F
    got = X.extract_text(spark.createDataFrame(data, "page_id bigint, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(0)), weights)
    by = {}
    for r in got.collect():
        by.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text)
    assert len(by[1]) == 2 and by[1][0].text == by[1][1].text == X.extract([PAGE], weights)[0]
    assert by[2][0].text == by[3][0].text == by[None][0].text == ""
    assert by[4][0].n_chars == 19 * 50_000 - 1
    assert X.extract_text(spark.createDataFrame([], "page_id bigint, url string, html string"), weights).count() == 0


def test_deep_nesting_takes_linear_time():
    import time

    from webfold.llm.dom import read
    began = time.time()
    for piece in ("<div>", "<div><p>x", "<span>", "<a>", "<li>"):
        assert len(read(piece * 100_000 + "text").parent) > 1
    assert time.time() - began < 30
