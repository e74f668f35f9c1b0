"""
same pages, same rows."""

import pytest

from gleanspark.operators.extract import ExtractSpec, Field, extract
from querybook import render
from tests.referee_html import extract_py
from gleanspark.plans import specs
from gleanspark.sources.tables import table
from tests.conftest import SF_ORACLE, SF_SMALL


def _same(a, b):
    assert a.columns == b.columns
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_nav_links_on_captured_pages(spark):
    pages = table(spark, SF_ORACLE, "pages").select("page_id", "html")
    native = extract(pages, specs.NAV_LINKS, keep=("page_id",))
    fallback = extract_py(pages, specs.NAV_LINKS, keep=("page_id",))
    _same(native, fallback)
    assert native.count() > 1000


@pytest.mark.parametrize("spec_name,render_fn,keep", [
    ("LISTING", lambda s: render.listing_pages(table(s, SF_SMALL, "part")), ("page",)),
    ("BOOK", lambda s: render.book_pages(table(s, SF_SMALL, "part")), ("page",)),
    ("DIRECTORY", lambda s: render.directory_pages(table(s, SF_SMALL, "customer"),
                                                   table(s, SF_SMALL, "nation")), ("category", "page")),
    ("TEAM_TABLE", lambda s: render.team_pages(table(s, SF_SMALL, "supplier")), ("page",)),
    ("QUOTE", lambda s: render.quote_pages(table(s, SF_SMALL, "events")).drop("url"), ("page",)),
])
def test_rendered_sites(spark, spec_name, render_fn, keep):
    spec = getattr(specs, spec_name)
    pages = render_fn(spark)
    _same(extract(pages, spec, keep=keep), extract_py(pages, spec, keep=keep))


def test_detail_pages(spark):
    pages = render.detail_pages(*(table(spark, SF_SMALL, t) for t in ("part", "lineitem", "supplier")))
    _same(extract(pages, specs.DETAIL, keep=("url",)), extract_py(pages, specs.DETAIL, keep=("url",)))


def test_nested_cards_need_the_fallback(spark):
    spec = ExtractSpec("nested", card="div.item", fields=(Field("name", "h4"), Field("price", "span.p")))
    html = ('<div class="item"><div class="inner"><h4>A</h4></div><span class="p">1</span></div>'
            '<div class="item"><div class="inner"><h4>B</h4></div></div>')
    pages = spark.createDataFrame([(1, html)], "page long, html string")
    rows = [(r.pos, r.name, r.price) for r in extract_py(pages, spec, keep=("page",)).collect()]
    assert rows == [(0, "A", "1"), (1, "B", None)]
