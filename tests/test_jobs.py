"""End-to-end jobs: captured inputs written to storage, suites written back."""

import os
import tempfile

from gleanspark.plans import jobs
from querybook import render
from gleanspark.sources.tables import table
from tests.conftest import SF_SMALL


def test_value_and_search_suites(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-jobs-")
    part, li, supp = (table(spark, SF_SMALL, t) for t in ("part", "lineitem", "supplier"))
    render.listing_pages(part).write.parquet(os.path.join(root, "listing"))
    render.detail_pages(part, li, supp).write.parquet(os.path.join(root, "details"))
    render.search_pages(part).write.parquet(os.path.join(root, "search"))
    out = jobs.value_suite_job(spark, os.path.join(root, "listing"), os.path.join(root, "details"),
                               os.path.join(root, "value"))
    assert set(out) == {"Combined", "Cheapest", "Top Rated", "Best Value"}
    best = spark.read.parquet(out["Best Value"]).orderBy("view_order").collect()
    assert best and all(a.value_score >= b.value_score for a, b in zip(best, best[1:]))
    out2 = jobs.search_suite_job(spark, os.path.join(root, "search"), os.path.join(root, "suite"))
    assert len(out2) == 12
    top = spark.read.parquet(out2["Top Cheapest 50"])
    assert top.count() == 50


def test_places_and_bookstore_suites(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-jobs-")
    cust, nat, reg, orde, pgs = (table(spark, SF_SMALL, t)
                                 for t in ("customer", "nation", "region", "orders", "pages"))
    render.place_search_table(cust, nat, reg, orde).write.parquet(os.path.join(root, "search"))
    render.place_detail_table(cust, nat, orde, pgs).write.parquet(os.path.join(root, "details"))
    pgs.write.parquet(os.path.join(root, "home"))
    out = jobs.places_suite_job(spark, os.path.join(root, "search"), os.path.join(root, "details"),
                                os.path.join(root, "places"), homepages_path=os.path.join(root, "home"))
    assert len(out) == 9
    assert spark.read.parquet(out["Top Rated"]).count() == 10
    render.book_pages(table(spark, SF_SMALL, "part")).write.parquet(os.path.join(root, "books"))
    out2 = jobs.bookstore_suite_job(spark, os.path.join(root, "books"), os.path.join(root, "bk"))
    assert len(out2) == 12


def test_site_table_jobs(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-sites-")
    sup = table(spark, SF_SMALL, "supplier")
    render.team_pages(sup).write.parquet(os.path.join(root, "teams"))
    assert jobs.site_table_job(spark, "teams", os.path.join(root, "teams"), os.path.join(root, "t"), fmt="csv")
    back = spark.read.option("header", True).csv(os.path.join(root, "t"))
    assert back.count() == sup.count()
    assert jobs.site_table_job(spark, "teams", os.path.join(root, "teams"), os.path.join(root, "s"),
                               team_query="#00000000")
    assert spark.read.parquet(os.path.join(root, "s")).count() == 10


def test_rejects_of_jobs(spark):
    """Blocked pages and rows that break strict rules go to the reject table; without one a
    strict rule stops the job; blocked pages never give rows."""
    import pytest
    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="gleanspark-rejects-")
    sup = table(spark, SF_SMALL, "supplier")
    pages = render.team_pages(sup, per_page=2).withColumn("html", F.when(
        F.col("page") == 1, F.lit("<h1>Captcha Interception</h1>")).when(F.col("page") == 2, F.regexp_replace(
            "html", '<td class="wins">', '<td class="wins">x')).otherwise(F.col("html")))
    pages.write.parquet(os.path.join(root, "teams"))
    args = (spark, "teams", os.path.join(root, "teams"))
    with pytest.raises(Exception):
        jobs.site_table_job(*args, os.path.join(root, "strict"))
    assert jobs.site_table_job(*args, os.path.join(root, "good"), rejects=os.path.join(root, "bad"))
    bad = sorted((r.page, r.pos, r.reason) for r in spark.read.parquet(os.path.join(root, "bad")).collect() if r.pos is not None)
    assert bad == [("2", 0, "wins: not a number"), ("2", 1, "wins: not a number")]
    assert [r.page for r in spark.read.parquet(os.path.join(root, "bad")).filter("pos is null").collect()] == ["1"]
    good = spark.read.parquet(os.path.join(root, "good"))
    assert good.filter("page in (1, 2)").count() == 0 and good.count() == sup.count() - 4
    # unknown rating words, unequal lists
    html = '<article class="product_pod"><p class="star-rating {}"></p><h3><a title="T">t</a></h3><p class="price_color">1</p></article>'
    spark.createDataFrame([(1, html.format("Two")), (2, html.format("Nine"))], "page long, html string") \
        .write.parquet(os.path.join(root, "cat"))
    assert jobs.site_table_job(spark, "catalogue", os.path.join(root, "cat"), os.path.join(root, "c"), rejects=os.path.join(root, "cbad"))
    assert [r.reason for r in spark.read.parquet(os.path.join(root, "cbad")).collect()] == ["unknown rating word"]
    entry = "<h3 class='country-name'>{}</h3><span class='country-capital'>c</span><span class='country-population'>{}</span>" \
            "<span class='country-area'>2.5</span>"
    spark.createDataFrame([(1, entry.format("A", "1") + entry.format("B", "many")), (2, entry.format("C", "3") + "<h3 class='country-name'>D</h3>")],
                          "page long, html string").write.parquet(os.path.join(root, "countries"))
    assert jobs.site_table_job(spark, "countries", os.path.join(root, "countries"), os.path.join(root, "k"), rejects=os.path.join(root, "kbad"))
    assert [(r.name, r.population) for r in spark.read.parquet(os.path.join(root, "k")).collect()] == [("A", 1.0)]
    assert sorted((r.page, r.pos, r.reason) for r in spark.read.parquet(os.path.join(root, "kbad")).fillna(-1).collect()) == [
        ("1", 1, "population: not a number"), ("2", -1, "lists differ in length: name 2, capital 1, population 1, area 1")]


def test_result_pages_and_quotes_in_order(spark):
    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="gleanspark-order-")
    row = '<table><tr class="team"><td class="name">N{}</td>' + "".join(
        f'<td class="{c}">1</td>' for c in ("year", "wins", "losses", "ot-losses", "pct", "gf", "ga", "diff")) + "</tr></table>"
    results = [("a", 1, row.format(1)), ("a", 2, row.format(2)), ("a", 3, "<p>none</p>"), ("a", 4, row.format(4)), ("b", 1, "<p>none</p>")]
    spark.createDataFrame(results, "query string, page long, html string").write.parquet(os.path.join(root, "r"))
    assert jobs.site_table_job(spark, "team_results", os.path.join(root, "r"), os.path.join(root, "ro"))
    assert sorted(r.name for r in spark.read.parquet(os.path.join(root, "ro")).collect()) == ["N1", "N2"]
    quote = '<div class="quote"><span class="text">Q{}</span><small class="author">A</small><a class="tag">t</a></div>'
    chain = [(f"/{k}", quote.format(k) + (f'<li class="next"><a href="/{n}">next</a></li>' if n else ""))
             for k, n in ((5, 3), (3, 9), (9, None))]
    spark.createDataFrame(chain, "url string, html string").write.parquet(os.path.join(root, "q"))
    assert jobs.site_table_job(spark, "quotes_in_order", os.path.join(root, "q"), os.path.join(root, "qo"))
    got = spark.read.parquet(os.path.join(root, "qo")).orderBy("start_url", "depth", "pos").collect()
    assert [(r.start_url, r.depth, r.text) for r in got] == [("/5", 0, "Q5"), ("/5", 1, "Q3"), ("/5", 2, "Q9")]
