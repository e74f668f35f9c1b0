"""Smaller captured-site pipelines: catalogue, countries, team tables, quotes with tags,
business directory and bookstore (SURVEY 0, 2.2)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.classify import home_city_address, is_blocked
from gleanspark.functions.numbers import (bracket_count, map_lookup, price_block, price_marker,
                                          strict_cast, zero_if_empty)
from gleanspark.functions.text import clean_text
from gleanspark.functions.urls import normalize_url, prefix_url
from gleanspark.operators.chain import chain_order
from gleanspark.operators.dedup import drop_exact_duplicates, keep_first
from gleanspark.operators.extract import extract, extract_lists, extract_lists_checked
from gleanspark.operators.rejects import REASON, lenient, not_a, with_reason
from gleanspark.plans import specs
from gleanspark.plans.specs import RATING_WORDS

BOOK_BASE = "https://books.example"


def catalogue(pages: DataFrame) -> DataFrame:
    """Catalogue rows; the rating word must be one of the five (C13, strict)."""
    x = extract(pages, specs.CATALOGUE, keep=("page",))
    return x.select("page", "pos", "title", "price",
                    map_lookup("rating_word", RATING_WORDS, strict=True).alias("rating"))


def catalogue_checked(pages: DataFrame) -> DataFrame:
    """``catalogue`` with a ``reason`` instead of a stop at an unknown rating word."""
    x = extract(pages, specs.CATALOGUE, keep=("page",))
    rating = map_lookup("rating_word", RATING_WORDS)
    return with_reason(x, {"unknown rating word": rating.isNull()}).select(
        "page", "pos", "title", "price", rating.alias("rating"), REASON)


def countries(pages: DataFrame) -> DataFrame:
    """Page-wide lists zipped by position; unequal lengths fail the job."""
    return extract_lists(pages, specs.COUNTRIES, keep=("page",), strict=True)


def countries_checked(pages: DataFrame) -> DataFrame:
    """``countries``; a page whose lists differ in length is a reject, and so are entries whose
    figures are no numbers."""
    spec = replace(specs.COUNTRIES, fields=tuple(
        f if f.post is None or f.name == "name" else replace(f, post=None) for f in specs.COUNTRIES.fields))
    x = extract_lists_checked(pages, spec, keep=("page",))
    figures = ("population", "area")
    bad = {f"{c}: not a number": not_a(c, "double") for c in figures}
    marked = with_reason(x.withColumnRenamed(REASON, "_page_reason"), bad)
    return marked.withColumn(REASON, F.coalesce("_page_reason", REASON)).drop("_page_reason") \
        .withColumns({c: lenient(c, "double") for c in figures})


#: Typed cells of a team row: name -> (type, blank counts as 0).
_TEAM_CELLS = {"year": ("int", False), "wins": ("int", False), "losses": ("int", False), "ot_losses": ("int", True),
               "win_pct": ("double", True), "gf": ("int", False), "ga": ("int", False), "diff": ("int", False)}


def team_checked(pages: DataFrame, keep=("page",)) -> DataFrame:
    """``team_table`` with a ``reason`` that names every cell which is no number."""
    x = extract(pages, specs.TEAM_TABLE, keep=keep)
    texts = {c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("0")) if blank else F.trim(c)
             for c, (_, blank) in _TEAM_CELLS.items()}
    marked = with_reason(x, {f"{c}: not a number": not_a(texts[c], to) for c, (to, _) in _TEAM_CELLS.items()})
    return marked.select(*keep, "pos", "name",
                         *[lenient(texts[c], to).alias(c) for c, (to, _) in _TEAM_CELLS.items()], REASON)


def team_table(pages: DataFrame, keep=("page",)) -> DataFrame:
    """B07 + C09 (empty -> 0 for OT losses and win %) + C10 (strict casts)."""
    x = extract(pages, specs.TEAM_TABLE, keep=keep)
    return x.select(
        *keep, "pos", "name",
        strict_cast("year", "int").alias("year"), strict_cast("wins", "int").alias("wins"),
        strict_cast("losses", "int").alias("losses"),
        zero_if_empty("ot_losses", "int").alias("ot_losses"),
        zero_if_empty("win_pct", "double").alias("win_pct"),
        strict_cast("gf", "int").alias("gf"), strict_cast("ga", "int").alias("ga"),
        strict_cast("diff", "int").alias("diff"))


def stop_at_first_empty(rows: DataFrame, frontier: DataFrame, group: str = "query",
                        page: str = "page") -> DataFrame:
    """D12 + F06: keep rows of result pages before the first page (per ``group``) that had
    no row. ``frontier`` lists every (group, page) that was read, so empty pages count.

    The pages to keep are found at page grain (one row per page); the rows then take part
    in one semi join on (group, page), so a group holding most rows is spread over its
    pages.
    """
    counts = rows.groupBy(group, page).agg(F.count(F.lit(1)).alias("n"))
    per_page = frontier.select(group, page).distinct().join(counts, [group, page], "left")
    first_empty = per_page.filter(F.col("n").isNull()).groupBy(group) \
        .agg(F.min(page).alias("_first_empty"))
    read = per_page.filter(F.col("n").isNotNull()).join(first_empty, group, "left") \
        .filter(F.col("_first_empty").isNull() | (F.col(page) < F.col("_first_empty")))
    return rows.join(read.select(group, page), [group, page], "left_semi")


def team_search(pages: DataFrame, q: str) -> DataFrame:
    """Rows of unfiltered team pages whose name contains ``q``, in any case. The stop at
    the first empty page (D12) belongs to the result pages of a search, not to these."""
    return team_table(pages).filter(F.lower("name").contains(q.lower()))


def team_search_results(pages: DataFrame) -> DataFrame:
    """Rows of the result pages ``(query, page, html)`` of team searches, up to the first
    page of each query without a row."""
    rows = team_table(pages, keep=("query", "page"))
    return stop_at_first_empty(rows, pages)


def quotes(pages: DataFrame) -> DataFrame:
    """Quotes with their tags joined by ', ' (B10)."""
    x = extract(pages, specs.QUOTE, keep=("page",))
    return x.select("page", "pos", "text", "author", F.array_join("tags", ", ").alias("tags"))


def quote_lists(pages: DataFrame) -> DataFrame:
    """Every quote text and every author of a page, zipped by position, texts as read."""
    return extract_lists(pages, specs.QUOTE_LISTS, keep=("page",), strict=True)


def quotes_in_order(pages: DataFrame, base: str, starts: DataFrame | None = None) -> DataFrame:
    """Quotes as a reader of the page chain sees them: ``start_url, depth, pos`` and the
    fields. ``pages`` has ``url, html``; ``base`` is put in front of every url and link, '' for
    none. ``starts`` (url) are the pages where reading begins, by default those that no page
    links to."""
    absolute = pages.withColumn("url", prefix_url("url", base))
    links = extract(absolute.select("url", "html"), specs.NEXT_LINK, keep=("url",))
    walk = chain_order(links.select("url", prefix_url("next_href", base).alias("next_url")), starts)
    found = extract(absolute.select("url", "html"), specs.QUOTE, keep=("url",))
    return walk.join(found, "url").select("start_url", "depth", "pos", "text", "author",
                                          F.array_join("tags", ", ").alias("tags"))


def route_blocked(pages: DataFrame, url: str = "url", html: str = "html",
                  marker: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages to extract, reject table). A blocked page gives no record; the reject
    table keeps its columns but the html, and why it was blocked, for another capture. Pages
    without a column ``url`` are judged by their html."""
    at = F.col(url) if url in pages.columns else F.lit("")
    blocked = is_blocked(html, at)
    if marker:
        blocked = blocked | F.coalesce(F.col(html).contains(marker), F.lit(False))
    reason = F.when(is_blocked(html, at), F.lit("captcha")).otherwise(F.lit("marker"))
    return pages.filter(~blocked), pages.filter(blocked).withColumn("reason", reason).drop(html)


def directory(pages: DataFrame) -> DataFrame:
    """Directory: name and address required (D01), home-city filter (D03), category
    from the page (A09), exact 4-column dedup with NULL = NULL (F02)."""
    x = extract(pages, specs.DIRECTORY, keep=("category", "page"))
    rows = x.filter(home_city_address("address")).select("name", "address", "phone", "category")
    return drop_exact_duplicates(rows, ["name", "address", "phone", "category"])


def books_raw(pages: DataFrame, base: str = BOOK_BASE) -> DataFrame:
    """Bookstore raw rows: link, title and current price required; first card per
    URL after validation (F03); price block (B15), bracket count (B16)."""
    x = extract(pages, specs.BOOK, keep=("page",))
    pb = price_block("price_text", "strike_text")
    cards = x.select(
        "page", "pos",
        clean_text("raw_title").alias("raw_title"), clean_text("raw_author").alias("raw_author"),
        pb["current"].alias("raw_current_price"), pb["old"].alias("raw_original_price"),
        bracket_count(clean_text("card_text")).alias("ratings_count"),
        clean_text("stock_text").alias("stock_text"),
        normalize_url("href", base).alias("url"))
    valid = cards.filter(F.col("url").isNotNull() & F.col("raw_title").isNotNull()
                         & (F.col("raw_title") != "") & F.col("raw_current_price").isNotNull())
    first = keep_first(valid, "url", ["page", "pos"])
    return first.select("raw_title", "raw_author", "raw_current_price", "raw_original_price",
                        "ratings_count", "stock_text", "url")


def books_clean(raw: DataFrame) -> DataFrame:
    """Bookstore clean table (C01 on texts, C08 price)."""
    out = raw.select(
        clean_text("raw_title").alias("title"), clean_text("raw_author").alias("author"),
        clean_text("raw_current_price").alias("current_price"),
        clean_text("raw_original_price").alias("original_price"),
        price_marker(clean_text("raw_current_price")).alias("current_price_num"),
        "ratings_count", "stock_text", "url")
    return out.na.drop(subset=["title", "current_price_num", "url"])
