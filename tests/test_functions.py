"""Scalar cases of FIXTURES.md section 2, one table per function."""

import pytest
from pyspark.sql import functions as F

from gleanspark import functions as G


def _eval(spark, fn, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_text(spark):
    got = _eval(spark, G.clean_text, ["  a \t\n b ", "a b", None, "x"])
    assert got == ["a b", "a b", None, "x"]


def test_clean_text_idempotent(spark):
    vals = ["  a \t\n b ", "a  b  c", "", " "]
    once = _eval(spark, G.clean_text, vals)
    twice = _eval(spark, G.clean_text, once)
    assert once == twice


def test_normalize_url(spark):
    base = "https://shop.example"
    got = _eval(spark, lambda c: G.normalize_url(c, base), [
        "//shop.example/p/x-i1.html?q=1", "/p/a;v=1?x#y", "p/a", "HTTPS://Ex.COM/A?b",
        "https://ex.com/a b?x", None])
    assert got == ["https://shop.example/p/x-i1.html", "https://shop.example/p/a",
                   "https://shop.example/p/a", "https://Ex.COM/A", "https://ex.com/a b", None]
    again = _eval(spark, lambda c: G.normalize_url(c, base), got[:-1])
    assert again == got[:-1]


def test_url_join_keeps_query(spark):
    got = _eval(spark, lambda c: G.url_join(c, "https://shop.example/a/b"),
                ["c?x=1", "/d?y", "//h.example/z#f"])
    assert got == ["https://shop.example/a/c?x=1", "https://shop.example/d?y",
                   "https://h.example/z#f"]


def test_quote_query(spark):
    df = spark.range(1).select(G.quote_query("kawaii pen/x~*").alias("q"))
    assert df.first()[0] == "kawaii%20pen/x~%2A"


def test_prices(spark):
    vals = ["৳ 1,234.50", "৳ 100 - ৳ 200", "abc", "", None]
    assert _eval(spark, G.price_strict, vals) == [1234.5, None, None, None, None]
    assert _eval(spark, G.price_first, vals) == [1234.5, 100.0, None, None, None]
    assert _eval(spark, G.price_marker, ["TK. 1,200", "Tk 50", "TK150.75", "tk 50", "free"]) \
        == [1200.0, 50.0, 150.75, 50.0, None]


def test_int_float(spark):
    assert _eval(spark, G.clean_int, ["1,234 Ratings", "No Ratings", "5 of 10", ",5"]) \
        == [1234, None, 5, 5]
    assert _eval(spark, G.clean_float, ["4.7/5", "-3.5", "1,234.5"]) == [4.7, 3.5, 1.0]


def test_zero_if_empty_and_strict(spark):
    assert _eval(spark, G.zero_if_empty, ["", " 4 ", None]) == [0, 4, 0]
    with pytest.raises(Exception):
        _eval(spark, lambda c: G.strict_cast(c, "int"), ["x1"])


def test_map_lookup(spark):
    m = {"One": 1, "Two": 2}
    assert _eval(spark, lambda c: G.map_lookup(c, m), ["One", "Nine"]) == [1, None]
    with pytest.raises(Exception):
        _eval(spark, lambda c: G.map_lookup(c, m, strict=True), ["Nine"])


def test_price_block(spark):
    df = spark.createDataFrame([
        ("TK. 200", None), ("TK. 300", "TK. 300"), ("TK. 300 TK. 250", "TK. 300"),
        ("TK. 300 TK. 250", None), ("Free", None), ("TK. 150.50", None)], "t string, s string")
    got = [tuple(r[0]) for r in df.select(G.price_block("t", "s")).collect()]
    assert got == [("TK. 200", None), (None, "TK. 300"), ("TK. 250", "TK. 300"),
                   ("TK. 250", "TK. 300"), (None, None), ("TK. 150", None)]


def test_domain_site_class(spark):
    assert _eval(spark, G.get_domain, ["https://www.Ex.com:80/a", "http://ex.com?x",
                                       "ftp://ex.com", "www.ex.com", None]) \
        == ["Ex.com:80", "ex.com", None, None, None]
    assert _eval(spark, G.website_type, [None, "https://FACEBOOK.com/x", "https://a.example", ""]) \
        == ["No Website", "Facebook", "Official Website", "No Website"]


def test_money(spark):
    df = spark.createDataFrame([(("BDT", "2", "125000000"),), ((None, "bad", None),), (None,)],
                               "m struct<currencyCode:string,units:string,nanos:string>")
    got = [r[0] for r in df.select(G.money_to_text("m")).collect()]
    assert got == ["BDT 2.12", "0.00", None]


def test_classes(spark):
    assert _eval(spark, G.rating_category, [None, 4.5, 4.0, 3.0, 2.99], "x double") \
        == ["No Rating", "Excellent", "Good", "Average", "Poor"]
    assert _eval(spark, G.price_category, ["Free", "Cheap", "Moderate", "Very Expensive", None]) \
        == ["Unknown", "Budget", "Mid-range", "Premium", "Unknown"]
    assert _eval(spark, G.place_kind, ["Fried Grill", "Cafe X", None]) \
        == ["Grill Burger", "Cafe Burger", "General Burger"]
    assert _eval(spark, G.home_city_address, ["Road 1, Dhaka", "Dhaka Rd, Sylhet", None]) \
        == [True, False, False]


def test_scores(spark):
    df = spark.createDataFrame([(4.5, 200, 100.0), (4.5, None, 100.0), (4.5, 10, 0.0),
                                (None, 10, 5.0)], "r double, n long, p double")
    got = [r[0] for r in df.select(G.value_score("r", "n", "p")).collect()]
    assert [None if g is None else round(g, 6) for g in got] == [0.135, 0.045, None, None]
    df2 = spark.createDataFrame([(4.0, "Moderate"), (4.0, "Free"), (4.0, None)], "r double, l string")
    assert [r[0] for r in df2.select(G.level_score("r", "l")).collect()] == [2.0, None, None]


def test_email(spark):
    assert _eval(spark, G.extract_email, ["write to ána.b@ex-1.com now", "none", None]) \
        == ["ána.b@ex-1.com", None, None]


def test_html_text_modes(spark):
    frag = ["<p> a <b>b</b>\n c&amp;d </p>"]
    assert _eval(spark, lambda c: G.html_text(c, "raw"), frag) == [" a b\n c&d "]
    assert _eval(spark, lambda c: G.html_text(c, "strip"), frag) == ["a b\n c&d"]
    assert _eval(spark, lambda c: G.html_text(c, "tight"), frag) == ["abc&d"]
    assert _eval(spark, lambda c: G.html_text(c, "space"), frag) == ["a b c&d"]
    assert _eval(spark, lambda c: G.html_text(c, "clean"), frag) == ["a b c&d"]


def test_guards_and_coercion(spark):
    assert _eval(spark, G.coerce_double, ["1.5", "x", None, "NaN"]) == [1.5, None, None, None]
    assert _eval(spark, G.is_nonempty, [" a ", "  ", None]) == [True, False, False]
    assert _eval(spark, G.safe_lower, ["AbC", None]) == ["abc", ""]
    assert _eval(spark, lambda c: G.remove_chars(c, '"'), ['"Bangladesh"']) == ["Bangladesh"]
    assert _eval(spark, lambda c: G.first_truthy(c, F.lit("fb")), ["", None, "a"]) == ["fb", "fb", "a"]


def test_preview(spark):
    from gleanspark.operators.views import columns_last, move_before, preview
    df = spark.range(100).select("id", (F.col("id") * 2).alias("x"), F.lit("u").alias("url"))
    assert preview(df, [("id", "asc")], 10).count() == 10
    assert columns_last(df, ("id", "missing")).columns == ["x", "url", "id"]
    assert move_before(df, "url", "x").columns == ["id", "url", "x"]


def test_numeric_character_references(spark):
    import html
    vals = ["it&#39;s", "&#x2019;q&#8220;", "a&#128512;b", "&amp;#39; stays", "none", "&#X41;&#66;C"]
    assert _eval(spark, G.html_unescape, vals) == [html.unescape(v) for v in vals]


def test_unescape_matches_python(spark):
    import html
    vals = ["&apos;x", "&amp;apos;", "&eacute;t&eacute; &mdash; 5&nbsp;%", "&lt;b&gt;&amp;lt;", "plain", "a & b"]
    assert _eval(spark, G.html_unescape, vals + [None]) == [html.unescape(v) for v in vals] + [None]


def test_unescape_names_numbers_and_bare_forms(spark):
    import html
    vals = ["&check; &copy x", "&#150;&#128;&#129;", "tail &amp", "&notit; &notin;", "&#0; &#xD800; &#1114112; &#99999999999999999999999;",
            "&#11;x&#127;y&#65535;z", "&; &# &#x; &#xg &unknown; &ampx &&amp;&", "&NotEqualTilde;&fjlig;", "&CounterClockwiseContourIntegral;"]
    assert _eval(spark, G.html_unescape, vals) == [html.unescape(v) for v in vals]


def test_filters_pass_the_decoder(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = df.select("doc_id", G.html_unescape(F.col("text")).alias("t")).filter("doc_id > 5") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(doc_id,5)" in plan.split("PushedFilters")[1]
