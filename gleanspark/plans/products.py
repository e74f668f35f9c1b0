"""Product pipelines: search suite, listing x detail, value views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.numbers import clean_float, clean_int, price_first, price_strict
from gleanspark.functions.score import value_score
from gleanspark.functions.text import clean_text
from gleanspark.functions.urls import normalize_url, strip_url
from gleanspark.operators.dedup import keep_first
from gleanspark.operators.extract import extract
from gleanspark.operators.views import columns_last
from gleanspark.plans import specs

BASE = "https://shop.example"


def listing_raw(pages: DataFrame, base: str = BASE, keep=("page",)) -> DataFrame:
    """Search raw rows: cards with link, name and price (D01), first card per
    normalized URL (F03); name and price as read."""
    raw = extract(pages, specs.LISTING, keep=keep)
    cards = raw.select(*keep, "pos", "raw_name", clean_text("raw_price").alias("raw_price"),
                       normalize_url("href", base).alias("url"))
    return keep_first(cards, "url", [*keep, "pos"])


def listing(pages: DataFrame, base: str = BASE, dedup_before_filter: bool = False,
            keep=("page",)) -> DataFrame:
    """Listing (A): extract cards, normalize the link, keep the first card per URL.

    Default (F03): a card must have link, name and price before it is seen, so an
    invalid first card does not hide a later valid one. ``dedup_before_filter``
    (F04) marks the URL as seen first, as the campaign pipeline does.
    """
    if dedup_before_filter:
        raw = extract(pages, specs.LISTING_LENIENT, keep=keep)
        cards = raw.select(*keep, "pos", clean_text("raw_name").alias("name"),
                           clean_text("raw_price").alias("price"),
                           normalize_url("href", base).alias("url"))
        first = keep_first(cards.filter(F.col("url").isNotNull()), "url", [*keep, "pos"])
        first = first.filter((F.col("name") != "") & (F.col("price") != ""))
    else:
        first = listing_raw(pages, base, keep).select(
            *keep, "pos", clean_text("raw_name").alias("name"), F.col("raw_price").alias("price"), "url")
    return first.select(*keep, "pos", "name", "price",
                        price_first("price").alias("price_num"), "url")


def campaign(pages: DataFrame, base: str = BASE) -> DataFrame:
    """Campaign products: URL by ``urljoin`` keeping the query (C03); the URL is seen
    before validation (F04); no-discount swap (B20); name and price required."""
    from gleanspark.functions.numbers import swap_if_no_discount
    from gleanspark.functions.urls import url_join
    x = extract(pages, specs.CAMPAIGN, keep=("page",))
    cards = x.select("page", "pos", url_join("href", base).alias("url"), "name", "current_price", "old_price")
    first = keep_first(cards.filter(F.col("url").isNotNull() & (F.col("url") != "")), "url", ["page", "pos"])
    sw = swap_if_no_discount("current_price", "old_price")
    out = first.select("name", sw["current"].alias("current_price"), sw["old"].alias("old_price"), "url")
    return out.filter(F.col("name").isNotNull() & F.col("current_price").isNotNull())


def search_clean(raw: DataFrame) -> DataFrame:
    """Search clean table from raw rows: C01 on name and price, strict price (C04);
    rows without name, price or URL dropped."""
    name = clean_text("raw_name") if "raw_name" in raw.columns else F.col("name")
    price = clean_text("raw_price") if "raw_price" in raw.columns else F.col("price")
    out = raw.select(name.alias("name"), price.alias("price"), price_strict(price).alias("price_num"), "url")
    return out.na.drop(subset=["name", "price_num", "url"])


def detail_table(detail_pages: DataFrame, keep=("url",), exclusive_counts: bool = True) -> DataFrame:
    """Detail (A): one record per detail page (B23), counts by label (B17, or the
    case-sensitive B18 variant with ``exclusive_counts=False``) with the count block
    as fallback (B19). ``extract_ok`` marks pages that gave any field (B22)."""
    d = extract(detail_pages, specs.DETAIL, keep=keep)
    rating_count, answered = labelled_counts("summary_links", exclusive_counts)
    out = d.select(
        *keep,
        clean_float("rating_text").alias("rating_score"),
        F.coalesce(rating_count, clean_int("count_text")).alias("rating_count"),
        answered.alias("answered_questions"),
        clean_text("brand").alias("brand"),
        clean_text("seller").alias("seller"),
        clean_text("description").alias("description"),
    )
    ok = F.lit(False)
    for c in ("rating_score", "rating_count", "answered_questions", "brand", "seller", "description"):
        ok = ok | F.col(c).isNotNull()
    return out.withColumn("extract_ok", ok)


def labelled_counts(links, exclusive: bool = True):
    """B17/B18 on an ``array<string>`` of link texts: (rating_count, answered).

    ``exclusive`` (B17): lower text containing ``rating`` counts as ratings, else
    ``answered question``; the last match wins. Otherwise (B18): case-sensitive
    ``Rating`` / ``Answered``, both tests applied to every text.
    """
    links = F.col(links) if isinstance(links, str) else links
    if exclusive:
        r = F.filter(links, lambda x: F.lower(x).contains("rating"))
        a = F.filter(links, lambda x: ~F.lower(x).contains("rating")
                     & F.lower(x).contains("answered question"))
    else:
        r = F.filter(links, lambda x: x.contains("Rating"))
        a = F.filter(links, lambda x: x.contains("Answered"))
    return (clean_int(F.try_element_at(r, F.lit(-1))), clean_int(F.try_element_at(a, F.lit(-1))))


def final_products(listing_df: DataFrame, detail_df: DataFrame) -> DataFrame:
    """Listing left-joined with details on URL (E01), value score (C35), URL last.

    Detail URLs are reduced like listing URLs (no query, fragment or parameters) and made
    unique: of several captures of a page one that gave fields wins. Both sides hash on
    ``url``; when the detail side is small the planner broadcasts it by its measured size.
    """
    ok = [~F.col("extract_ok")] if "extract_ok" in detail_df.columns else []
    d = keep_first(detail_df.withColumn("url", strip_url("url")).filter(F.col("url").isNotNull()), "url",
                   ok or [c for c in detail_df.columns if c != "url"])
    j = listing_df.join(d, "url", "left")
    front = [c for c in listing_df.columns if c not in ("url", "pos")]
    scored = j.select(
        *front, "url",
        F.round(value_score("rating_score", "rating_count", "price_num"), 6).alias("value_score"),
        "rating_score", "rating_count", "answered_questions", "brand", "seller", "description")
    return columns_last(scored, ("url",))
