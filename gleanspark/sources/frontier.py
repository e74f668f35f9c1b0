"""Page frontiers and work skipping.

A frontier is a table of pages to read. It is generated with ``sequence`` +
``explode`` from a per-query page count (no cross join), so its size follows the
counts, and resume is a ``left_anti`` join against what is already stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.functions.urls import quote_query
from gleanspark.session import checkpoint_dir


def page_range(df: DataFrame, n_pages: str, start: int = 1, page_col: str = "page") -> DataFrame:
    """One row per page number ``start .. start + n_pages - 1`` of each input row
    (each query, category, ...)."""
    n = F.col(n_pages)
    seq = F.when(n >= 1, F.sequence(F.lit(start), n + (start - 1))).otherwise(F.array().cast("array<int>"))
    return df.withColumn(page_col, F.explode(seq))


def fill_template(template: str, **slots: Column) -> Column:
    """``format``-style URL template with named slots filled by columns."""
    out = F.lit(template)
    for k, v in slots.items():
        out = F.replace(out, F.lit("{" + k + "}"), v.cast("string"))
    return out


def search_frontier(queries: DataFrame, template: str, n_pages: str = "n_pages",
                    query_col: str = "query", max_pages: int | None = None) -> DataFrame:
    """A03 + A05 (+ A10): URL per (query, page) with the query percent-encoded.
    ``max_pages`` caps the pages read per query (the cap is the feature)."""
    q = queries
    if max_pages is not None:
        q = q.withColumn(n_pages, F.least(F.col(n_pages), F.lit(max_pages)))
    pages = page_range(q, n_pages)
    return pages.select(query_col, "page",
                        fill_template(template, q=quote_query(F.col(query_col)), page=F.col("page")).alias("url"))


def segmented_frontier(segments: DataFrame, order_col: str = "seg_order") -> DataFrame:
    """Segments ``(category, first_url, page_url, n_pages)`` -> one row per page
    with a running index over all segments. Page 1 of a segment is ``first_url``, page
    ``i > 1`` is ``page_url`` with ``{page}`` = i.

    Segments are dealt by range of ``order_col``. Offsets are taken in two levels: totals
    of the ranges first (as many rows as partitions), segments inside a range second, so
    no task holds all segments.
    """
    checkpoint_dir(segments.sparkSession)
    dealt = segments.repartitionByRange(order_col).withColumn("_range", F.spark_partition_id()).checkpoint()
    ranges = dealt.groupBy("_range").agg(F.sum("n_pages").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    seg = dealt.join(ranges, "_range").withColumn(
        "_offset", F.col("_base") + F.coalesce(F.sum("n_pages").over(inside), F.lit(0)))
    pages = page_range(seg, "n_pages")
    url = F.when(F.col("page") == 1, F.col("first_url")).otherwise(
        F.replace(F.col("page_url"), F.lit("{page}"), F.col("page").cast("string")))
    return pages.select("category", "page", (F.col("_offset") + F.col("page")).alias("run_index"),
                        url.alias("url"))


def remaining(frontier: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Frontier rows whose key is not stored yet (``left_anti``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return frontier.join(done.select(*keys).distinct(), keys, "left_anti")


def remaining_urls(listing: DataFrame, details: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Listing URLs without a stored detail. With ``retry_failed`` a stored row
    that extracted nothing (``extract_ok`` false) does not count as done."""
    done = details.filter(F.col("extract_ok")) if retry_failed else details
    return remaining(listing, done, "url")
