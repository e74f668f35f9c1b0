"""Rule tables turned into ``CASE WHEN`` chains.

A rule list is data; the functions build one native expression from it, so a new
class set is a new list, not new code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions._util import col_of

# The classes of the places pipeline, in rule order (first hit wins).
KIND_RULES = [
    ("grill", "Grill Burger"),
    ("fried", "Fried Chicken + Burger"),
    ("cafe", "Cafe Burger"),
    ("fast food", "Fast Food Burger"),
]
KIND_DEFAULT = "General Burger"

AREA_RULES = [
    ("gulshan", "Gulshan"),
    ("dhanmondi", "Dhanmondi"),
    ("uttara", "Uttara"),
]
AREA_DEFAULT = "Other"

# API price code -> label, label -> level number.
PRICE_TEXT_MAP = {
    "PRICE_LEVEL_FREE": "Free",
    "PRICE_LEVEL_INEXPENSIVE": "Cheap",
    "PRICE_LEVEL_MODERATE": "Moderate",
    "PRICE_LEVEL_EXPENSIVE": "Expensive",
    "PRICE_LEVEL_VERY_EXPENSIVE": "Very Expensive",
}
PRICE_LEVEL_NUM = {"Free": 0, "Cheap": 1, "Moderate": 2, "Expensive": 3, "Very Expensive": 4}

PRICE_CATEGORY = [
    (["Cheap"], "Budget"),
    (["Moderate"], "Mid-range"),
    (["Expensive", "Very Expensive"], "Premium"),
]
PRICE_CATEGORY_DEFAULT = "Unknown"

# Fixed values: (minimum, label), highest first; below the last -> RATING_LOWEST; NULL -> RATING_NULL.
RATING_BUCKETS = [(4.5, "Excellent"), (4.0, "Good"), (3.0, "Average")]
RATING_LOWEST = "Poor"
RATING_NULL = "No Rating"

# Directory address filter: must name Dhaka and none of these cities.
HOME_CITY = "dhaka"
OTHER_CITIES = ["barisal", "chittagong", "khulna", "mymensingh", "rajshahi", "rangpur", "sylhet"]

# Blocked-page markers and the logged-in marker.
BLOCK_TEXT = "Captcha Interception"
BLOCK_URL = "_____tmd_____/punish"
LOGIN_MARK = "Logout"


def keyword_class(c, rules, default: str | None) -> Column:
    """First rule whose keyword occurs in ``lower(c)`` wins; NULL text is ''."""
    txt = F.coalesce(F.lower(col_of(c)), F.lit(""))
    expr = None
    for kw, label in rules:
        cond = txt.contains(kw.lower())
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def bucket(c, buckets, lowest: str, null_label: str) -> Column:
    """C22 generic: ``buckets`` = [(min, label)...] from highest to lowest."""
    c = col_of(c)
    expr = F.when(c.isNull(), F.lit(null_label))
    for lo, label in buckets:
        expr = expr.when(c >= lo, F.lit(label))
    return expr.otherwise(F.lit(lowest))


def website_type(u) -> Column:
    """NULL/empty -> No Website; facebook / instagram; else Official Website."""
    low = F.lower(col_of(u))
    return (F.when(low.isNull() | (low == ""), F.lit("No Website"))
            .when(low.contains("facebook.com"), F.lit("Facebook"))
            .when(low.contains("instagram.com"), F.lit("Instagram"))
            .otherwise(F.lit("Official Website")))


def place_kind(name) -> Column:
    """C19."""
    return keyword_class(name, KIND_RULES, KIND_DEFAULT)


def area_class(address) -> Column:
    """C20."""
    return keyword_class(address, AREA_RULES, AREA_DEFAULT)


def price_category(level) -> Column:
    """Level label -> category; anything else (Free, NULL) -> Unknown."""
    lv = col_of(level)
    expr = None
    for labels, cat in PRICE_CATEGORY:
        cond = lv.isin(labels)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr.otherwise(F.lit(PRICE_CATEGORY_DEFAULT))


def rating_category(r) -> Column:
    """C22."""
    return bucket(r, RATING_BUCKETS, RATING_LOWEST, RATING_NULL)


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test, NULL -> false."""
    return F.coalesce(F.lower(col_of(c)).contains(needle.lower()), F.lit(False))


def home_city_address(address, home: str = HOME_CITY, others=OTHER_CITIES) -> Column:
    """Names the home city and none of the other cities (case-insensitive)."""
    low = F.lower(col_of(address))
    ok = low.contains(home)
    for city in others:
        ok = ok & ~low.contains(city)
    return F.coalesce(ok, F.lit(False))


def is_blocked(html, url) -> Column:
    """A captcha page or a punish URL."""
    return F.coalesce(col_of(html).contains(BLOCK_TEXT), F.lit(False)) | \
        F.coalesce(col_of(url).contains(BLOCK_URL), F.lit(False))


def is_logged_in(html) -> Column:
    """D14."""
    return F.coalesce(col_of(html).contains(LOGIN_MARK), F.lit(False))
