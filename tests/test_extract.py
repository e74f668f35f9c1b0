"""Extractor fixtures: small hand-written pages per selector feature (FIXTURES.md 4)."""

import pytest

from gleanspark.operators.extract import ExtractSpec, Field, extract, extract_lists
from gleanspark.plans import specs

LISTING_PAGE = """<html><head><script>var t='<div data-qa-locator="product-item">x</div></p>';</script>
<!-- <div data-qa-locator="product-item"><a title="ghost" href="/g"></a></div> --></head><body>
<section>
<div class="c" data-qa-locator="product-item"><a href="/p/a"><img></a>
  <a title="Pen &amp; Ink" href="/p/a?x=1">Pen</a><span class="ooOxS"> ৳  1,200 </span></div>
<div class="c" data-qa-locator="product-item"><a title="No price" href="/p/b"></a></div>
<div class="c" data-qa-locator="product-item"><a title="Pen dup" href="/p/a?y=2"></a><span class="ooOxS">৳ 90</span></div>
</section><footer><span class="ooOxS">৳ 1</span></footer></body></html>"""


def _pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page long, html string")


def test_card_explode_required_and_order(spark):
    rows = extract(_pages(spark, LISTING_PAGE), specs.LISTING, keep=("page",)).collect()
    assert [(r.pos, r.raw_name, r.href, r.raw_price) for r in rows] == [
        (0, "Pen & Ink", "/p/a?x=1", "৳ 1,200"), (2, "Pen dup", "/p/a?y=2", "৳ 90")]


def test_lenient_spec_keeps_invalid_cards(spark):
    rows = extract(_pages(spark, LISTING_PAGE), specs.LISTING_LENIENT, keep=("page",)).collect()
    assert [r.raw_price for r in rows] == ["৳ 1,200", None, "৳ 90"]


def test_listing_pipeline_dedups_by_normalized_url(spark):
    from gleanspark.plans.products import listing
    rows = listing(_pages(spark, LISTING_PAGE)).collect()
    assert [(r.pos, r.name, r.price_num, r.url) for r in rows] == [
        (0, "Pen & Ink", 1200.0, "https://shop.example/p/a")]


def test_unclosed_p_ends_at_next_block(spark):
    html = "<article><h1>T</h1><p><b>one<br><p>two</p><p>  </p><div>x</div><p>three</article><p>out</p>"
    rows = extract(_pages(spark, html), specs.PARAGRAPHS, keep=("page",)).collect()
    assert rows[0].paras == ["one", "two", "three"]


def test_fallback_chain_and_many(spark):
    spec = ExtractSpec("d", None, (
        Field("brand", ("a.brand-link", "div.brand a")),
        Field("links", "a.sum", many=True),
        Field("missing", ("span.none", "b.none")),
    ))
    html = ('<div class="brand"><span>B:</span> <a href="/b"> Acme </a></div>'
            '<a class="sum x">5 Ratings</a><a class="x sum">3 Answered Questions</a><a class="summ">no</a>')
    r = extract(_pages(spark, html), spec, keep=("page",)).first()
    assert (r.brand, r.links, r.missing) == ("Acme", ["5 Ratings", "3 Answered Questions"], None)


def test_attribute_selectors(spark):
    spec = ExtractSpec("a", None, (
        Field("book", 'a[href*="/book/"]', attr="href"),
        Field("tok", 'input[name="csrf_token"]', attr="value"),
        Field("titled", "a[title]", attr="title"),
        Field("single", "a.q", attr="href"),
    ))
    html = ("<a href='/author/1'>x</a><a href=\"/book/7/x\">b</a><input type=hidden name=\"csrf_token\" "
            "value=\"abc\"><a title=\"T\" href=\"/t\"></a><a class='q' href='/single'>s</a>")
    r = extract(_pages(spark, html), spec, keep=("page",)).first()
    assert (r.book, r.tok, r.titled, r.single) == ("/book/7/x", "abc", "T", "/single")


def test_icon_guarded_field(spark):
    html = ('<div class="company"><h3><a>Name</a></h3><div class="address">A, Dhaka</div>'
            '<div class="s"><i class="fa fa-globe"></i><span>web</span></div>'
            '<div class="s"><i class="fa fa-phone"></i></div>'
            '<div class="s"><i class="fa fa-phone"></i><span> 017 </span></div></div>'
            '<div class="company"><h3><a>Other</a></h3><div class="address">B, Dhaka</div></div>')
    rows = extract(_pages(spark, "<main>" + html + "</main>"), specs.DIRECTORY, keep=("page",)).collect()
    assert [(r.name, r.phone) for r in rows] == [("Name", "017"), ("Other", None)]


def test_scoped_card_split(spark):
    html = "<ul><li><a href='/x'>x</a></li></ul><nav><ul><li><a href='/a'>A</a></li><li><a href='/b'>B</a></li></ul></nav>"
    rows = extract(_pages(spark, html), specs.NAV_LINKS, keep=("page",)).collect()
    assert [(r.pos, r.href, r.text) for r in rows] == [(0, "/a", "A"), (1, "/b", "B")]


def test_parallel_lists_zip_and_strict(spark):
    ok = "<h3 class='country-name'>\"A\"</h3><span class='country-capital'>a</span>" \
         "<span class='country-population'>1</span><span class='country-area'>2.5</span>"
    rows = extract_lists(_pages(spark, ok), specs.COUNTRIES, keep=("page",)).collect()
    assert [(r.name, r.capital, r.population, r.area) for r in rows] == [("A", "a", 1.0, 2.5)]
    bad = ok + "<h3 class='country-name'>B</h3>"
    with pytest.raises(Exception):
        extract_lists(_pages(spark, bad), specs.COUNTRIES, keep=("page",)).collect()


def test_catalogue_strict_rating_word(spark):
    from gleanspark.plans.sites import catalogue
    good = '<ol><article class="product_pod"><p class="star-rating Three"></p><h3><a title="T">t</a></h3>' \
           '<p class="price_color">£5.00</p></article></ol>'
    r = catalogue(_pages(spark, good)).first()
    assert (r.title, r.price, r.rating) == ("T", "£5.00", 3)
    bad = good.replace("Three", "Seven")
    with pytest.raises(Exception):
        catalogue(_pages(spark, bad)).collect()


def test_detail_page_variants(spark):
    from gleanspark.plans.products import detail_table
    full = ('<div class="score"><span class="score-average">4.5</span></div>'
            '<a class="pdp-review-summary__link">1,234 Ratings</a>'
            '<a class="pdp-review-summary__link">7 Answered Questions</a>'
            '<a class="pdp-product-brand__brand-link">Acme</a>'
            '<a class="seller-name__detail-name">Shop</a>'
            '<div class="html-content detail-content"><p>Nice &amp; good</p></div>')
    fallback = ('<div class="pdp-product-brand"><a>Acme2</a></div><div class="seller-name__detail"><a>S2</a></div>'
                '<article class="lzd-article">Text</article>')
    counts = '<div class="mod-rating"><div class="count">12 ratings</div></div>'
    empty = "<p>gone</p>"
    df = spark.createDataFrame([("u1", full), ("u2", fallback), ("u3", counts), ("u4", empty)], "url string, html string")
    got = {r.url: r for r in detail_table(df).collect()}
    assert (got["u1"].rating_score, got["u1"].rating_count, got["u1"].answered_questions,
            got["u1"].brand, got["u1"].seller, got["u1"].description) == (4.5, 1234, 7, "Acme", "Shop", "Nice & good")
    assert (got["u2"].brand, got["u2"].seller, got["u2"].description) == ("Acme2", "S2", "Text")
    assert (got["u3"].rating_count, got["u3"].answered_questions) == (12, None)
    assert got["u4"].extract_ok is False and got["u1"].extract_ok is True


def test_labelled_counts_variants(spark):
    from gleanspark.plans.products import labelled_counts
    df = spark.createDataFrame([(["5 Ratings", "3 Answered Questions"],), (["5 Ratings", "7 Ratings"],)],
                               "l array<string>")
    a = [tuple(r) for r in df.select(*labelled_counts("l")).collect()]
    assert a == [(5, 3), (7, None)]
    b = [tuple(r) for r in df.select(*labelled_counts("l", exclusive=False)).collect()]
    assert b == [(5, 3), (7, None)]


def test_long_tag_runs_and_deep_nesting(spark):
    """Long runs of tags and deep nesting: no regex recursion, no Python recursion."""
    from gleanspark.functions.text import html_text
    from tests.referee_html import extract_py
    from pyspark.sql import functions as F
    tags = "<p>a" + "<b></b>" * 50000 + " b</p>"
    deep = "<main>" + "<div>" * 5000 + '<div class="company"><h3><a>N</a></h3><div class="address">X, Dhaka</div>' \
        + "</div>" * 5001 + "</main>"
    df = _pages(spark, tags, deep)
    got = [r[0] for r in df.select(html_text("html", "space")).orderBy("page").collect()]
    assert got[0] == "a b"
    rows = extract_py(df, specs.DIRECTORY, keep=("page",)).collect()
    assert [(r.page, r.name) for r in rows] == [(1, "N")]


def _records(spark, spec, html):
    return [r.asDict() for r in extract(spark.createDataFrame([(1, html)], "page int, html string"), spec).collect()]


def test_elements_end_at_their_own_close(spark):
    from gleanspark.plans import specs
    html = ('<div class="html-content detail-content"><div>first part</div><div>second part</div><p>third</p></div>'
            '<div>after</div>')
    assert _records(spark, specs.DETAIL, html)[0]["description"] == "first part second part third"


def test_cards_keep_nested_sections_and_quoted_marks(spark):
    from gleanspark.plans import specs
    html = ('<section><div data-qa-locator="product-item"><section><b>x</b></section><div><div>q</div></div>'
            '<a title="A > B" href="/p/1">l</a><span class="ooOxS">10 <span>tk</span></span></div><p>ad</p>'
            '<div data-qa-locator="product-item"><a title=\'C\' href="/p/2">l</a><section></section>'
            '<span class="ooOxS">20</span></div></section><div data-x="1"><span class="ooOxS">99</span></div>')
    got = [(r["raw_name"], r["href"], r["raw_price"]) for r in _records(spark, specs.LISTING, html)]
    assert got == [("A > B", "/p/1", "10 tk"), ("C", "/p/2", "20")]


def test_many_nested_and_tagless(spark):
    spec = ExtractSpec("t", None, (Field("many", "div.a", many=True), Field("inside", "div.a span", many=True),
                                   Field("tagless", ".z"), Field("attr", "a[x]", attr="x")))
    html = ('<div class="a">1<div class="a">2<span>s1</span></div>3</div><div class="a"><span>s2<span>s3</span></span>'
            '</div><i class="z">k<i>l</i>m</i><a y="p>q" x="v>w">')
    assert _records(spark, spec, html)[0] == {
        "page": 1, "many": ["1 2 s1 3", "2 s1", "s2 s3"], "inside": ["s1", "s2 s3", "s3"],
        "tagless": "k l m", "attr": "v>w"}
