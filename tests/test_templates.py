"""Templates as repeated structures, whatever their text."""
from webfold.operators.templates import structures, template_subtrees


def found(spark, pages, **limits):
    df = spark.createDataFrame([(f"https://{host}/{k}", html) for k, (host, html) in enumerate(pages)], "url string, html string")
    return sorted((r.host, r.tag, r.n_elements, r.n_pages, r.host_pages) for r in template_subtrees(df, **limits).collect())


def shell(k, body=""):
    menu = "".join(f"<li><a href='/{k}/{i}'>item {k} {i}</a></li>" for i in range(k % 4 + 1))
    return f"<body><div id='top-{k}'><p>Hello {k}</p><ul class='b a'>{menu}</ul></div><article>{'<p>x</p>' * 3}</article>{body}</body>"


def test_a_template_with_varying_text_and_length(spark):
    pages = [("a.test", shell(k)) for k in range(6)] + [("b.test", shell(k)) for k in range(2)]
    # one structure: the div with its list; neither the list alone nor the equal articles
    assert found(spark, pages) == [("a.test", "div", 5, 6, 6), ("b.test", "div", 5, 2, 2)]


def test_shares_and_sizes(spark):
    extra = "<section><h2>r</h2><p>s <b>t</b></p></section>"
    pages = [("a.test", shell(k, extra if k < 2 else "<section><i>u</i></section>")) for k in range(5)]
    assert found(spark, pages) == [("a.test", "div", 5, 5, 5)]
    assert found(spark, pages, min_share_pct=40) == [("a.test", "div", 5, 5, 5), ("a.test", "section", 4, 2, 5)]
    assert found(spark, pages, min_elements=2, min_share_pct=60) == [("a.test", "div", 5, 5, 5), ("a.test", "section", 2, 3, 5)]


def test_a_part_that_also_stands_alone_is_reported(spark):
    part = "<ul><li><b>x</b></li></ul>"
    pages = [("a.test", f"<div><h2>h</h2>{part}</div>" + (f"<section><i>{'<u></u><s></s>' * k}</i>{part}</section>" if k else "")) for k in range(4)]
    assert ("a.test", "ul", 3, 4, 4) in found(spark, pages) and ("a.test", "div", 5, 4, 4) in found(spark, pages)


def test_odd_pages(spark):
    assert found(spark, [("a.test", None), ("a.test", ""), ("a.test", "text"), ("a.test", "<div>" * 500)]) == []
    assert template_subtrees(spark.createDataFrame([], "url string, html string")).count() == 0
    (key, (tag, size)), *_ = sorted(structures("<div id=x9><b>1</b></div>").items(), key=lambda e: -e[1][1])
    assert (tag, size) == ("div", 2) and key[0] == max(structures("<div id=x10>t<b></b></div>").items(), key=lambda e: e[1][1])[0][0]
