"""End-to-end jobs: captured inputs on storage -> view suites and site tables on storage.

Each job reads captured pages (``page, html`` or ``url, html``) or JSON responses from
Parquet. Blocked pages (D13) leave before extraction; where a job is given a ``rejects``
folder, they and what its strict rules turn away are written there as ``page, pos, reason``,
and without one a strict rule stops the job. A suite's clean base is built once, persisted,
and all its views are written in one pass (``sources.sinks.write_suite``). These replace the
single-machine scripts: same views, any input size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from gleanspark.operators import rejects as rej
from gleanspark.operators import views
from gleanspark.plans import places, products, sites
from gleanspark.session import scratch_path
from gleanspark.sources.sinks import write_suite, write_table


def _suite(views_: views.ViewSuite, bases: tuple, out: str, fmt: str) -> dict[str, str]:
    """Every view written; the frames they share are computed once."""
    for base in bases:
        base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return write_suite(views_, out, fmt=fmt)
    finally:
        for base in bases:
            base.unpersist()


def _unblocked(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """The pages at ``path`` that are not blocked; the others go to ``rejects``."""
    good, blocked = sites.route_blocked(spark.read.parquet(path))
    if rejects:
        write_table(_page_rejects(blocked), rejects, mode="append", skip_empty=False)
    return good


def _page_rejects(blocked: DataFrame) -> DataFrame:
    page = next(c for c in ("page", "url", "page_id", *blocked.columns) if c in blocked.columns)
    return blocked.select(F.col(page).cast("string").alias("page"), F.lit(None).cast("int").alias("pos"), rej.REASON)


def search_suite_job(spark: SparkSession, pages_path: str, out: str, fmt: str = "parquet",
                     base_url: str = products.BASE, rejects: str | None = None) -> dict[str, str]:
    """Search pages -> 12 views."""
    raw = products.listing_raw(_unblocked(spark, pages_path, rejects), base_url)
    clean = products.search_clean(raw)
    return _suite(views.product_views(raw.select("raw_name", "raw_price", "url"), clean), (raw, clean), out, fmt)


def value_suite_job(spark: SparkSession, listing_pages_path: str, detail_pages_path: str, out: str,
                    fmt: str = "parquet", base_url: str = products.BASE, rejects: str | None = None) -> dict[str, str]:
    """Listing pages + detail pages (``url, html``) -> Combined, Cheapest, Top Rated,
    Best Value. A product whose detail page was blocked stays, without detail fields."""
    lst = products.listing(_unblocked(spark, listing_pages_path, rejects), base_url)
    det = products.detail_table(_unblocked(spark, detail_pages_path, rejects))
    final = products.final_products(lst, det)
    return _suite(views.value_views(final), (final,), out, fmt)


def bookstore_suite_job(spark: SparkSession, pages_path: str, out: str, fmt: str = "parquet",
                        base_url: str = sites.BOOK_BASE, rejects: str | None = None) -> dict[str, str]:
    """Bookstore search pages -> 12 views."""
    raw = sites.books_raw(_unblocked(spark, pages_path, rejects), base_url)
    clean = sites.books_clean(raw)
    return _suite(views.book_views(raw, clean), (raw, clean), out, fmt)


def places_suite_job(spark: SparkSession, search_path: str, details_path: str, out: str,
                     homepages_path: str | None = None, max_pages: int | None = None,
                     fmt: str = "parquet") -> dict[str, str]:
    """Search responses ``(query, query_idx, page_idx, body)`` + detail responses
    ``(id, status, body)`` [+ captured homepages ``(url, html)``] -> 9 views."""
    search = spark.read.parquet(search_path)
    details = spark.read.parquet(details_path)
    homepages = spark.read.parquet(homepages_path) if homepages_path else None
    raw = places.enrich(places.first_seen_places(search, max_pages), details).select(*places.RAW_COLUMNS)
    raw.persist(StorageLevel.MEMORY_AND_DISK)                # read by the measure and by the views
    shared = places.shared_sites(raw) if homepages is not None else None
    clean = places.clean_places(raw, homepages, shared)
    return _suite(views.place_views(raw, clean), (raw, clean), out, fmt)


SITE_TABLES = {
    "catalogue": sites.catalogue,
    "countries": sites.countries,
    "teams": sites.team_table,
    "team_results": sites.team_search_results,               # result pages (query, page, html), D12
    "quotes": sites.quotes,
    "quotes_in_order": lambda pages: sites.quotes_in_order(pages, ""),   # pages (url, html), B14
    "directory": sites.directory,
    "campaign": products.campaign,
}

#: Sites with strict rules, as frames that tell the reason instead of stopping.
CHECKED = {"catalogue": sites.catalogue_checked, "countries": sites.countries_checked, "teams": sites.team_checked}


def site_table_job(spark: SparkSession, site: str, pages_path: str, out: str, fmt: str = "parquet",
                   team_query: str | None = None, rejects: str | None = None) -> bool:
    """Captured pages of one single-table site -> one table (``fmt`` parquet, csv
    or json); False if there is no row. ``team_query`` keeps the team rows whose name
    contains it (D11); the result pages of a name search are the site ``team_results``, read up
    to the first page of a query without a row (D12). With ``rejects``, the strict rules of
    ``CHECKED`` sites turn rows away instead of stopping the job: the checked frame is written
    once and parted from there."""
    pages = _unblocked(spark, pages_path, rejects)
    if rejects and site in CHECKED:
        draft = scratch_path(spark, f"checked-{uuid.uuid4().hex}")
        checked = CHECKED[site](pages)
        checked.write.parquet(draft)
        df, bad = rej.split(spark.read.schema(checked.schema).parquet(draft))
        write_table(bad, rejects, mode="append", skip_empty=False)
    else:
        df = SITE_TABLES[site](pages)
    if site == "teams" and team_query:
        df = df.filter(F.lower("name").contains(team_query.lower()))
    return write_table(df, out, fmt=fmt)
