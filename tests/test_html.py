"""Node arrays and selectors on well-formed, broken and empty pages."""

import pytest
from pyspark.sql import functions as F

from hirelake.functions import html as H

SOUP = (
    '<!DOCTYPE html><body><div id="a" class="x y"><p>one<b>b<br><p>two &amp; x<ul><li>A<li class="k">B'
    '<ul><li>n</ul></ul><script>var t="</p>"; if (a<b) x()</script><!-- <a href="/no">no</a> -->'
    '<a href="//h/x?a=1&amp;b=2" class="w-1/2">L</a></div><table><tr><td>1<td>2<tr><td>3</table>end'
)


def run(spark, html, column, selectors=()):
    df = spark.createDataFrame([(html,)], "html string").select(H.html_nodes(F.col("html"), selectors).alias("n"))
    return df.select(column).first()[0]


@pytest.mark.parametrize("selector,want", [
    ("#a > p::text", ["one", "two & x"]),
    ("p b::text", ["b"]),
    ("#a > ul > li::text", ["A", "B"]),
    ("#a ul li::text", ["A", "B", "n"]),
    ("#a > ul > li *::text", ["n"]),
    ("li.k::text", ["B"]),
    ("li:nth-child(2)::text", ["B"]),
    ("div.y.x > a::attr(href)", ["//h/x?a=1&b=2"]),
    ("div *::attr(href)", ["//h/x?a=1&b=2"]),
    ("[class*=w-1]::text", ["L"]),
    ("tr:nth-of-type(2) > td::text", ["3"]),
    ("#a > ul:nth-of-type(1) li:nth-child(1)::text", ["A", "n"]),
    ("#missing *::text", []),
    ("script::text", ['var t="</p>"; if (a<b) x()']),
])
def test_selectors(spark, selector, want):
    assert run(spark, SOUP, H.select_all(F.col("n"), selector)) == want
    assert run(spark, SOUP, H.select_all(F.col("n"), selector), [selector]) == want


def test_first_and_element_texts(spark):
    assert run(spark, SOUP, H.select_first(F.col("n"), "li::text")) == "A"
    assert run(spark, SOUP, H.select_first(F.col("n"), "h9::text")) is None
    assert run(spark, SOUP, H.element_texts(F.col("n"), "#a > ul > li")) == ["A", "B n"]
    assert run(spark, SOUP, H.visible_text(H.first_within(F.col("n"), "h9"))) is None
    assert run(spark, SOUP, H.plain_text(H.first_within(F.col("n"), "#a"))) == "onebtwo & xABnL"


@pytest.mark.parametrize("html", [None, "", "   ", "no tags", "<", "<p", "<p title='x", "<script>never closed", "<!-- open"])
def test_odd_pages(spark, html):
    assert run(spark, html, H.select_all(F.col("n"), "a::attr(href)")) == []


def test_deep_nesting_keeps_text(spark):
    html = "<b>" * 2000 + "deep"
    assert run(spark, html, H.plain_text(F.col("n"))) == "deep"


def test_page_shortcuts_agree_with_nodes(spark):
    df = spark.createDataFrame([(SOUP + "<title>T &amp; t</title><a class=b href='/q'>q</a>",)], "html string")
    html = F.col("html")
    assert df.select(H.anchor_hrefs(html)).first()[0] == ["//h/x?a=1&b=2", "/q"]
    assert df.select(H.select_all(H.html_nodes(html), "a::attr(href)")).first()[0] == ["//h/x?a=1&b=2", "/q"]
    assert df.select(H.element_text(html, "title")).first()[0] == "T & t"


def test_html_text(spark):
    df = spark.createDataFrame([("<p>a&nbsp;b<br>c<script>x<y</script><!--z--> &lt;d</p>",), (None,)], "h string")
    assert [r[0] for r in df.select(H.html_text(F.col("h"))).collect()] == ["a\xa0bc <d", None]


def test_unknown_selector_is_an_error():
    with pytest.raises(ValueError):
        H.path_regex("p::before")


def test_anchor_with_angle_in_a_quoted_value(spark):
    html = "<a title='a > b' href='/x'>x</a><a class=c\nhref = /y>y</a><a data-href='/n'>n</a><a href=\"/z\" download>z</a>"
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(H.anchor_hrefs(F.col("html"))).first()[0] == ["/x", "/y", "/z"]
    nodes = H.html_nodes(F.col("html"))
    assert df.select(H.select_all(nodes, "a::attr(href)")).first()[0] == ["/x", "/y", "/z"]


def test_very_deep_pages_keep_texts_with_their_elements(spark):
    deep = "<div>" * 600 + "<p class='inner'>in</p></div>out" + "</div>" * 599 + "<p class='last'>end</p>"
    df = spark.createDataFrame([(deep,)], "html string")
    nodes = H.html_nodes(F.col("html"))
    assert df.select(H.select_first(nodes, "p.inner::text")).first()[0] == "in"
    assert df.select(H.select_first(nodes, "p.last::text")).first()[0] == "end"
    assert df.select(H.select_all(nodes, "div > p.last::text")).first()[0] == []
    assert df.select(H.plain_text(nodes)).first()[0] == "inoutend"


@pytest.mark.parametrize("piece", ["<a ", "<!--", "</a", "<!x", "<script>", "<a x='"])
def test_unclosed_markup_is_read_in_linear_time(spark, piece):
    import time

    df = spark.createDataFrame([(piece * 60_000,)], "html string")
    start = time.time()
    df.select(F.size(H.html_nodes(F.col("html"), ["p"])), F.size(H.anchor_hrefs(F.col("html")))).collect()
    assert time.time() - start < 20


def walked(html, selectors=()):
    regions = tuple(H._region(s) for s in selectors)
    return H._to_arrow([html], regions, ("href",)).to_pylist()[0]


@pytest.mark.parametrize("html", [
    "<div>" * 100_000 + "deep", "<b>" * 50_000 + "</i>" * 50_000, "<i><b>" * 25_000 + "</i>" * 25_000 + "</b>" * 25_000,
    "<p>" * 100_000, "<ul><li>" * 50_000, "<table><tr><td>" * 30_000,
])
def test_deep_and_unclosed_markup_is_walked_in_linear_time(html):
    import time

    start = time.perf_counter()
    nodes = walked(html)
    assert time.perf_counter() - start < 2
    assert sum(n["text"] is None for n in nodes) == html.count("<") - html.count("</")


def test_nodes_know_their_parents_and_subtrees():
    """Against a tree made from the steps' depths by hand."""
    for selectors in ((), ("ul",), ("li", "td")):
        nodes = walked(SOUP, selectors)
        for i, n in enumerate(nodes):
            inside = nodes[i + 1 : i + n["size"]]
            assert all(m["depth"] >= n["depth"] + (m["text"] is None) for m in inside)
            after = nodes[i + n["size"] : i + n["size"] + 1]
            assert n["text"] is not None or all(m["depth"] <= n["depth"] for m in after)
            if n["up"]:
                parent = nodes[i - n["up"]]
                assert parent["text"] is None and i < i - n["up"] + parent["size"]
                assert parent["depth"] == n["depth"] - (n["text"] is None)
            else:
                assert n["depth"] == (n["text"] is None)


def test_selectors_below_any_depth(spark):
    html = "<div>" * 5_000 + "<section><p class=x>in<b>b</b></p></section>" + "</div>" * 5_000
    nodes = F.col("n")
    for selector, want in [
        ("section > p.x::text", ["in"]), ("div > section > p > b::text", ["b"]), ("div section b::text", ["b"]), ("section > b::text", []),
    ]:
        assert run(spark, html, H.select_all(nodes, selector)) == want
    assert run(spark, html, H.element_texts(nodes, "section > p")) == ["in b"]


def test_parts_of_parts_are_node_arrays(spark):
    html = "<div class=c><ul><li><a href=/1>one</a><svg><g>icon</g></svg></li><li>two</li></ul></div><a href=/2>out</a>" * 2
    n = F.col("n")
    card = H.first_within(n, "div.c")
    assert run(spark, html, H.element_texts(H.first_within(card, "ul"), "li")) == ["one icon", "two"]
    assert run(spark, html, H.select_all(card, "li > a::attr(href)")) == ["/1"]
    assert run(spark, html, H.select_all(card, "div li::text")) == []
    assert run(spark, html, H.plain_text(H.outside(card, "svg"))) == "onetwo"
    assert run(spark, html, F.transform(H.elements(n, "div.c"), lambda p: H.select_first(H.within(n, p), "a::text"))) == ["one", "one"]


def test_a_page_of_many_cards_takes_time_in_proportion(spark):
    import time

    def seconds(cards):
        html = "".join(f"<div class=card><h2>t{i}</h2><p>a<b>b</b></p><a href=/{i}>x</a></div>" for i in range(cards))
        df = spark.createDataFrame([(html,)], "html string").select(H.html_nodes(F.col("html"), ["div.card"]).alias("n"))
        n = F.col("n")
        hrefs = F.transform(H.elements(n, "div.card"), lambda p: H.select_first(H.within(n, p), "a::attr(href)"))
        start = time.time()
        assert df.select(hrefs.alias("h")).first()[0] == [f"/{i}" for i in range(cards)]
        return time.time() - start

    seconds(50)
    assert seconds(16_000) < 20 * max(seconds(2_000), 0.4)


def test_fields_are_those_of_a_search_of_the_nodes(spark, monkeypatch):
    """One pass gives what select_all and elements give, on markup of any shape."""
    import random

    import pyspark.sql.functions as F

    monkeypatch.setattr(H, "PAGES_AT_ONCE", 3)
    rules = {
        "a": "#x > div *::text", "b": "div p::text", "c": "div:nth-child(2) > p:nth-of-type(1)::text", "d": "*.k::text",
        "e": "ul > li *::attr(href)", "f": "a::attr(href)", "g": "[class*=ar]", "h": "div div > p", "i": "ul li.k", "j": "title::text",
        "k": ".k .k::text", "l": "div > div > a::attr(href)", "m": "script::text", "n": "div *::text",
    }
    bits = ["<div>", '<div id="x">', '<div class="k">', '<div class="card k">', "</div>", "<p>", '<p class="k">', "</p>", "<ul>", "<li>", '<li class="k">',
            "</ul>", '<a href="/1">', "<a href>", "</a>", "t", " u &amp; v", "<br>", "<title>T&lt;</title>", "<script>s&amp;</script>", "<!-- c -->", "<"]
    rng = random.Random(1)
    pages = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for i in range(200)] + [(200, None)]
    df = spark.createDataFrame(pages, "id int, html string").repartition(2)
    places = [rule for rule in rules.values() if "::" not in rule]
    texts = lambda place: H.visible_text(H.within(F.col("_f.nodes"), place))
    old = df.select("id", H.html_nodes(F.col("html"), places).alias("_p"), H.html_nodes(F.col("html"), rules.values()).alias("_n")).select(
        "id", *[(H.select_all(F.col("_n"), r) if "::" in r else H.element_texts(F.col("_p"), r)).alias(k) for k, r in rules.items()],
    )
    new = df.select("id", H.html_fields(F.col("html"), rules).alias("_f")).select(
        "id", *[(F.col("_f")[k] if "::" in r else F.transform(F.col("_f")[k], texts)).alias(k) for k, r in rules.items()]
    )
    got, wanted = (sorted(map(tuple, x.collect())) for x in (new, old))
    assert got == wanted and all(any(row[i] for row in got) for i in range(1, len(rules) + 1))


def test_only_a_few_pages_are_parts_at_a_time(monkeypatch):
    most = []
    walk = H._walk
    monkeypatch.setattr(H, "_walk", lambda html, regions, picks, memo, nodes: (walk(html, regions, picks, memo, nodes), most.append(len(nodes.steps))))
    found = H._read(["<p>a</p>"] * 5000, (), H._Picks(["p::text"]))
    assert max(most) == 2 * H.PAGES_AT_ONCE
    assert [len(x) for x in found] == [5000, 5000] and found[1].to_pylist() == [["a"]] * 5000
