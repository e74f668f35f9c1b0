"""JSON place responses (A05-A07, A10, E05): search pages and detail responses are
input tables of JSON text, parsed with fixed schemas by ``from_json`` (only the
fields named in the schema are materialized)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.functions.numbers import MONEY_SCHEMA
from gleanspark.operators.dedup import keep_first

PRICE_RANGE = T.StructType([T.StructField("startPrice", MONEY_SCHEMA),
                            T.StructField("endPrice", MONEY_SCHEMA)])
_PLACE_FIELDS = [
    T.StructField("id", T.StringType()),
    T.StructField("displayName", T.StructType([T.StructField("text", T.StringType())])),
    T.StructField("formattedAddress", T.StringType()),
    T.StructField("priceLevel", T.StringType()),
    T.StructField("priceRange", PRICE_RANGE),
    T.StructField("rating", T.DoubleType()),
    T.StructField("userRatingCount", T.LongType()),
    T.StructField("googleMapsUri", T.StringType()),
]
PLACE = T.StructType(_PLACE_FIELDS)
DETAIL = T.StructType(_PLACE_FIELDS + [
    T.StructField("nationalPhoneNumber", T.StringType()),
    T.StructField("internationalPhoneNumber", T.StringType()),
    T.StructField("websiteUri", T.StringType()),
])
SEARCH = T.StructType([T.StructField("places", T.ArrayType(PLACE)),
                       T.StructField("nextPageToken", T.StringType())])

SEARCH_TABLE = "query string, query_idx int, page_idx int, body string"
DETAIL_TABLE = "id string, status int, body string"


def search_places(search: DataFrame, max_pages: int | None = None) -> DataFrame:
    """One row per place of every search page, with its origin
    ``(query, query_idx, page_idx, pos)``. A missing ``places`` gives no row; places
    without an id are dropped. ``max_pages`` keeps the first pages of each query
    (A10)."""
    if max_pages is not None:
        search = search.filter(F.col("page_idx") < max_pages)
    parsed = search.select("query", "query_idx", "page_idx",
                           F.from_json("body", SEARCH).alias("r"))
    places = parsed.select("query", "query_idx", "page_idx",
                           F.posexplode(F.coalesce(F.col("r.places"),
                                                   F.array().cast(T.ArrayType(PLACE)))).alias("pos", "p"))
    return places.filter(F.col("p.id").isNotNull() & (F.col("p.id") != ""))


def place_details(details: DataFrame, order: str | None = None) -> DataFrame:
    """Detail objects of successful responses (status 200), one per id: the first by
    ``order`` (a capture time, if the table has one), else the smallest body."""
    ok = details.filter(F.col("status") == 200)
    first = keep_first(ok.select("id", *([order] if order else []), "body"), "id",
                       [order, "body"] if order else ["body"])
    return first.select("id", F.from_json("body", DETAIL).alias("d"))
