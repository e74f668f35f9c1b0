"""Places pipeline: search pages -> first-seen places -> detail lookup
with fallbacks -> cleaning and classes -> 9 views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.classify import (PRICE_TEXT_MAP, area_class, contains_ci, place_kind,
                                           price_category, rating_category, website_type)
from gleanspark.functions.numbers import map_lookup, money_to_text
from gleanspark.functions.score import level_score
from gleanspark.functions.text import clean_text, extract_email, first_truthy
from gleanspark.functions.urls import get_domain, is_http_url
from gleanspark.operators.dedup import keep_first
from gleanspark.operators.skew import heavy_hitters, salted_join
from gleanspark.operators.views import move_before
from gleanspark.sources.places import place_details, search_places

#: Places of one website that one task takes; a website with more is dealt over several.
SITE_ROWS = 100_000

RAW_COLUMNS = ["id", "name", "address", "phone", "rating", "rating_count", "price_level",
               "price_start", "price_end", "maps_link", "website"]


def first_seen_places(search: DataFrame, max_pages: int | None = None) -> DataFrame:
    """a place found by several queries belongs to the first query (then page,
    then position) that returned it."""
    p = search_places(search, max_pages).select("query_idx", "page_idx", "pos",
                                                F.col("p.id").alias("id"), "p")
    return keep_first(p, "id", ["query_idx", "page_idx", "pos"])


def enrich(places: DataFrame, details: DataFrame) -> DataFrame:
    """E05 + C24-C26: left join with details on id; a failed or missing detail keeps
    the place with its search fields. Fallbacks: name, address, link, level by
    first-truthy; rating and count by first-not-null; the price range only when both
    of its ends are empty."""
    d = place_details(details)
    j = places.join(d, "id", "left")
    s_start, s_end = money_to_text(F.col("p.priceRange.startPrice")), money_to_text(F.col("p.priceRange.endPrice"))
    d_start, d_end = money_to_text(F.col("d.priceRange.startPrice")), money_to_text(F.col("d.priceRange.endPrice"))
    both_empty = (F.coalesce(s_start, F.lit("")) == "") & (F.coalesce(s_end, F.lit("")) == "")
    level_code = first_truthy(F.col("p.priceLevel"), F.col("d.priceLevel"))
    return j.select(
        "id",
        first_truthy(F.col("p.displayName.text"), F.col("d.displayName.text")).alias("name"),
        first_truthy(F.col("p.formattedAddress"), F.col("d.formattedAddress")).alias("address"),
        first_truthy(F.col("d.nationalPhoneNumber"), F.col("d.internationalPhoneNumber")).alias("phone"),
        F.coalesce(F.col("p.rating"), F.col("d.rating")).alias("rating"),
        F.coalesce(F.col("p.userRatingCount"), F.col("d.userRatingCount")).alias("rating_count"),
        map_lookup(level_code, PRICE_TEXT_MAP).alias("price_level"),
        F.when(both_empty, d_start).otherwise(s_start).alias("price_start"),
        F.when(both_empty, d_end).otherwise(s_end).alias("price_end"),
        first_truthy(F.col("p.googleMapsUri"), F.col("d.googleMapsUri")).alias("maps_link"),
        F.col("d.websiteUri").alias("website"),
    )


def shared_sites(raw: DataFrame, rows: int = SITE_ROWS) -> dict[str, int]:
    """Websites that very many places name, measured: website -> shares of ``rows`` places."""
    return heavy_hitters(raw.select(F.trim("website").alias("site")), "site", rows)


def clean_places(raw: DataFrame, pages: DataFrame | None, shared: dict[str, int] | None = None) -> DataFrame:
    """Cleaning, in the reference order: address filter (D04) -> domain (C17) ->
    website type (C18) -> e-mail from the captured homepage of official websites
    only (D16, E06, C23) -> kind and price/rating classes on raw text (C19, C21, C22)
    -> clean every text column (C27) -> value score (C37) -> area on the cleaned
    address (C20) -> website before the maps link (C32).

    The homepage join is a left join of places (already filtered) with the captured
    pages reduced to ``(site, email)`` -- the wide ``html`` column never crosses the
    shuffle. ``shared`` (see ``shared_sites``) names the websites that are dealt over several
    tasks; without it the planner alone splits what is skewed.
    """
    df = raw.filter(contains_ci("address", "dhaka"))
    wtype = website_type("website")
    if pages is not None:
        # captured homepages by the exact URL that was read; of several captures of one
        # URL the first (by page id, if there is one) that has an address counts
        first = ["page_id"] if "page_id" in pages.columns else []
        mails = pages.select(F.trim("url").alias("_site"), *first, extract_email("html").alias("_mail")) \
            .filter(F.col("_mail").isNotNull())
        mails = keep_first(mails, "_site", first or ["_mail"]).select("_site", "_mail")
        official = (wtype == "Official Website") & is_http_url("website")
        # places that take no e-mail get a unique key that matches nothing, so they
        # spread over the join partitions instead of all hashing to the NULL key; the rows
        # of websites in ``shared`` are dealt over their shares
        site = F.when(official, F.trim("website")).otherwise(F.concat(F.lit("\u0001"), F.col("id")))
        df = salted_join(df.withColumn("_site", site), mails, "_site", spread="id", heavy=shared or {})
        email = F.col("_mail")
    else:
        email = F.lit(None).cast("string")
    # one projection: classes read the raw name / level (before C27), the area reads
    # the cleaned address (after C27)
    texts = {f.name for f in raw.schema.fields if f.dataType.simpleString() == "string"} - {"id"}
    out = {c: (clean_text(c) if c in texts else F.col(c)) for c in RAW_COLUMNS}
    cols = [out[c].alias(c) for c in RAW_COLUMNS] + [
        clean_text(get_domain("website")).alias("domain"),
        clean_text(wtype).alias("website_type"),
        clean_text(email).alias("email"),
        clean_text(place_kind("name")).alias("kind"),
        price_category("price_level").alias("price_category"),
        rating_category("rating").alias("rating_category"),
        F.round(level_score("rating", clean_text("price_level")), 6).alias("value_score"),
        area_class(clean_text("address")).alias("area"),
    ]
    return move_before(df.select(*cols), "website", "maps_link")


def places_pipeline(search: DataFrame, details: DataFrame, pages: DataFrame | None,
                    max_pages: int | None = None, shared: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    raw = enrich(first_seen_places(search, max_pages), details).select(*RAW_COLUMNS)
    return raw, clean_places(raw, pages, shared)
