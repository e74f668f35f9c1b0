"""Element ends, attributes and their cost: native expressions against the referee."""

import random
import time

import pytest
from pyspark.sql import functions as F

from gleanspark.operators.elements import attributes, select
from gleanspark.operators.extract import ExtractSpec, Field, extract, parse_selector
from gleanspark.plans import specs
from tests.referee_html import extract_py


def _pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page long, html string")


def _rows(df):
    return [r.asDict() for r in df.orderBy("page", *(["pos"] if "pos" in df.columns else [])).collect()]


def _both(spark, spec, *htmls):
    pages = _pages(spark, *htmls)
    got, want = (_rows(x(pages, spec, keep=("page",))) for x in (extract, extract_py))
    assert got == want
    return got


def test_table_inside_a_cell(spark):
    html = ('<table><tr class="team"><td class="name">A <table><tr><td class="x">in</td></tr><tr><td>ner</table> B'
            '<td class="year">1999<td class="wins">7</tr><tr class="team"><td class="name">C</td>'
            '<td class="year">2000</td></tr></table>')
    got = _both(spark, specs.TEAM_TABLE, html)
    assert [(" ".join(r["name"].split()), r["year"], r["wins"]) for r in got] == [
        ("A inner B", "1999", "7"), ("C", "2000", None)]


def test_menu_inside_an_item(spark):
    spec = ExtractSpec("menu", card="li", fields=(Field("text", None, mode="space"), Field("href", "a", attr="href")))
    html = '<ul><li>One<ul><li>sub<li><a href="/b">b</a></ul>tail</li><li>Two<ol><li>x</li></ol></ul><li>Three'
    got = _both(spark, spec, html)
    assert [r["text"] for r in got] == ["One sub b tail", "sub", "b", "Two x", "x", "Three"]
    assert [r["href"] for r in got] == ["/b", None, "/b", None, None, None]


def test_paragraphs_and_definitions(spark):
    spec = ExtractSpec("t", None, (Field("p", "p", many=True), Field("dt", "dt", many=True), Field("dd", "dd", many=True)))
    html = "<p>a<b>c</b><p>d<hr>e<div><p>f</div>g<dl><dt>h<dd>i<dl><dt>j</dl>k<dt>l</dl><p>m"
    assert _both(spark, spec, html) == [{"page": 0, "p": ["a c", "d", "f", "m"], "dt": ["h", "j", "l"],
                                         "dd": ["i j k"]}]


def test_unquoted_bare_and_repeated_attributes(spark):
    spec = ExtractSpec("t", card="div.c", fields=(
        Field("href", "a", attr="href"), Field("kind", "a[data-k=v]".replace("=v", '="v"'), attr="href"),
        Field("bare", "input[checked]", attr="value"), Field("part", 'a[href*="x&y"]', attr="href"),
        Field("own", None, attr="class")))
    html = ("<div class=c><a href=/x>1</a><a data-k=v href='/v&amp;w'>2</a></div>"
            '<DIV CLASS="b c" class="d"><input checked value=7><a HREF="/?x&amp;y=1">3</a></DIV>'
            '<div class="d" class="c">no</div><div data-class="c">no</div><div class="cc c-c">no</div>'
            '<div title="class=\'c\'">no</div><div title=" class=c ">no</div>')
    got = _both(spark, spec, html)
    assert [(r["href"], r["kind"], r["bare"], r["part"], r["own"]) for r in got] == [
        ("/x", "/v&w", None, None, "c"), ("/?x&y=1", None, "7", "/?x&y=1", "b c")]


def test_attribute_map(spark):
    tags = ['<a href=/x/ Title="A &amp; B" x=\'1\' href=2 checked data-q="">', "<br>", '<a b="c"d=e/f=g>',
            '<i a = "1"  b= 2 c =3>']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in tags], "t string").select(attributes("t")).collect()]
    assert got == [{"href": "/x/", "title": "A &amp; B", "x": "1", "checked": "", "data-q": ""}, {},
                   {"b": "c", "d": "e/f=g"}, {"a": "1", "b": "2", "c": "3"}]


def test_random_pages_against_the_referee(spark):
    """Nested, unclosed and stray tags of every kind."""
    rnd = random.Random(8)
    opens = ["<div class=a>", '<div class="b a">', "<div>", "<span>", "<ul>", "<ol class=a>", "<li>", "<li class='a'>",
             "<table>", "<tr>", "<tr class=a>", "<td>", '<td class="a">', "<th>", "<b class=a>", "<p>", "<p class=a>"]
    closes = ["</div>", "</span>", "</ul>", "</ol>", "</li>", "</table>", "</tr>", "</td>", "</th>", "</b>", "</p>"]

    def well_formed(depth):
        kind = rnd.choice(["div", "span", "ul", "table", "text", "text", "b"] if depth < 5 else ["text"])
        mark = rnd.choice(["", " class=a", ' class="x a"'])
        if kind == "text":
            return f"t{rnd.randint(0, 99)}"
        if kind == "ul":
            close = rnd.choice(["</li>", ""]) if loose else "</li>"
            return f"<ul{mark}>" + "".join(f"<li{rnd.choice(['', ' class=a'])}>{body(depth)}{close}"
                                           for _ in range(rnd.randint(0, 3))) + "</ul>"
        if kind == "table":
            cell, row = (rnd.choice(["</td>", ""]), rnd.choice(["</tr>", ""])) if loose else ("</td>", "</tr>")
            return f"<table{mark}>" + "".join(
                f"<tr{rnd.choice(['', ' class=a'])}>" + "".join(f"<td{mark}>{body(depth)}{cell}" for _ in range(2)) + row
                for _ in range(rnd.randint(0, 3))) + "</table>"
        return f"<{kind}{mark}>{body(depth)}</{kind}>"

    def body(depth):
        return "".join(well_formed(depth + 1) for _ in range(rnd.randint(0, 3)))

    loose = True
    good = ["<main>" + "".join(well_formed(0) for _ in range(6)) + "</main>" for _ in range(60)]
    fields = tuple(Field(f"f{i}", s, mode="space", many=True) for i, s in enumerate(
        ("div", "div.a", "li", "li.a", "td", "td.a", "tr.a", "ul li", "div.a li.a", "table td", "span", "b.a")))
    _both(spark, ExtractSpec("r", None, fields), *good)
    loose = False                                            # without a name: all closed
    closed = ["<main>" + "".join(well_formed(0) for _ in range(6)) + "</main>" for _ in range(40)]
    _both(spark, ExtractSpec("n", None, (Field("f", ".a", mode="space", many=True), Field("g", "ul .a", many=True))), *closed)
    for card in ("div.a", "li", "tr", "td.a"):
        _both(spark, ExtractSpec("c", card, (Field("t", None, mode="space"), Field("l", "li", many=True))), *good)
    # stray and missing tags of one kind: items without a list, rows without a table
    for kind in ("li", "td", "div"):
        soup = ["".join(rnd.choice([f"<{kind}>", f"<{kind} class=a>", f"</{kind}>", "x", "y"]) for _ in range(12))
                for _ in range(100)]
        _both(spark, ExtractSpec("s", None, (Field("f", kind, many=True), Field("g", f"{kind}.a", mode="raw", many=True))),
              *soup)
    torn = ["".join(rnd.choice(opens + closes + ["x"]) for _ in range(30)) for _ in range(100)]
    assert extract(_pages(spark, *torn), ExtractSpec("t", None, fields)).count() == 100      # no page fails


@pytest.mark.parametrize("kind", ["nested", "flat", "items"])
def test_time_grows_with_the_page_only(spark, kind):
    """Thousands of matches in one page: under a second, about twice the time for twice as many."""
    make = {"nested": lambda n: '<div class="a">' * 20 + "<div><div class='a'>x</div></div>" * n + "</div>" * 20,
            "flat": lambda n: "<div class=a>some words here and there</div>" * n,
            "items": lambda n: "<ul>" + "<li class=a>x<ul><li>y</ul>" * n + "</ul>"}[kind]
    step = "li.a" if kind == "items" else "div.a"
    took = {}
    for n in (200, 2_000, 8_000):
        page = _pages(spark, make(n)).repartition(1).cache()
        page.count()
        best = 99.0
        for _ in range(3):
            t = time.time()
            found = page.select(F.size(select("html", parse_selector(step), outermost=kind == "nested"))).first()[0]
            best = min(best, time.time() - t)
        took[n] = best
        assert found == (1 if kind == "nested" else n)
    assert took[2_000] < 2.0 and took[8_000] < 8 * took[2_000] + 2.0, took
