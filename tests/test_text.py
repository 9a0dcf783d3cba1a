import datetime as dt
from html import unescape

from pyspark.sql import functions as F

from webfold.functions import text as T
from webfold.operators.pages import front_matter


def got(spark, rows, f):
    df = spark.createDataFrame(rows, "s string, want string")
    return [(r.s, r.want, r.got) for r in df.select("s", "want", f(F.col("s")).cast("string").alias("got")).collect()]


def test_word_count(spark):
    rows = [("", "0"), (" \t\n", "0"), ("rake", "1"), ("\u00a0rake \u2003 hoe\u3000", "2"), ("a\nb\tc\x0bd\re", "5"), (None, "0")]
    for s, want, have in got(spark, rows, T.word_count):
        assert want == have, s


def test_normalize_markdown(spark):
    rows = [("# Frost\r\rCover\r\n\r\n\r\n\r\nbeds", "# Frost\n\nCover\n\nbeds"), ("\n \t x \n\n", "x"), ("a\n \nb", "a\n \nb"), (" \n", "")]
    for s, want, have in got(spark, rows, T.normalize_markdown):
        assert want == have, s


def test_character_references(spark):
    cases = ["a &amp;lt; b", "caf&eacute; &uuml;ber", "&#233;t&#xE9;", "&#0000000065;&#x00000041;", "&#38;lt;", "&copy;&hellip;&nbsp;x", "&xyzzy; & &;", "A&B&", "&amp;amp;amp;",
             "&#xD800;|&#0;|&#x110000;|&#99999999999999999999999;", "no reference", "", "&NotEqualTilde;&lang;&rang;"]
    rows = [(c, unescape(c)) for c in cases]
    for s, want, have in got(spark, rows, T.decode_entities):
        assert want == have, s


def test_front_matter(spark):
    df = spark.createDataFrame([("https://garden.test/frost", "", 'Frost: "what to\\do"', "Ann", "", 12, "ff00")],
                               "u string, c string, t string, b string, s string, w int, h string")
    ts = F.lit(dt.datetime(2031, 11, 5, 6, 7, 8)).cast("timestamp")
    fm = df.select(front_matter(F.col("u"), F.col("c"), F.col("t"), F.col("b"), F.col("s"), ts, F.col("w"), F.col("h")).alias("fm")).first().fm
    assert fm == ('---\nurl: "https://garden.test/frost"\ntitle: "Frost: \\"what to\\\\do\\""\nbyline: "Ann"\n'
                  'crawled_at: "2031-11-05T06:07:08Z"\nword_count: 12\ncontent_hash: "ff00"\n---\n')


MARKDOWN = [
    ("<h2>Soil</h2><p>Dig <b>deep</b> &amp; wide.</p>", "## Soil\n\nDig **deep** & wide."),
    ("<ol><li>one</li><li>two</ol><ul><li>three</ul>", "1. one\n1. two\n\n- three"),
    ("<p><strong>a <em>b</em></strong> <em>c <b>d</b></em></p>", "**a *b*** *c **d***"),
    ("<p><a href=/x>x</a> <a class='k' href='/y?a=1'>y</a> <a href=\"/z\">z</a></p>", "[x](/x) [y](/y?a=1) [z](/z)"),
    ("<pre><code>if x:\n    dig()  # now</code></pre><p>then   rest</p>", "```\nif x:\n    dig()  # now\n```\n\nthen rest"),
    ("<blockquote><p>first</p><p>second<br>third</p></blockquote>after", "> first\n>\n> second\n>\n> third\n\nafter"),
    ("<p>use <code>rake()</code></p><hr>", "use `rake()`\n\n* * *"),
    ("", ""),
]


def test_markdown_of_html(spark):
    from webfold.operators.pages import to_markdown
    df = spark.createDataFrame(MARKDOWN, "content_html string, want string")
    for r in to_markdown(df).collect():
        assert r.markdown == r.want, r.content_html


def test_go_quote(spark):
    rows = [('a "b" \\c', '"a \\"b\\" \\\\c"'), ("x\ty\n", '"x\\ty\\n"'), ("\x01\x7f", '"\\x01\\x7f"'), ("a\u00a0b\u200b", '"a\\u00a0b\\u200b"'), ("ünï 🌻", '"ünï 🌻"'),
            ("\U000e0001", '"\\U000e0001"'), ("", '""')]
    for s, want, have in got(spark, rows, T.go_quote):
        assert want == have, s
