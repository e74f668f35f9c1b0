"""Sorted, banded, keyword and top-k views over one clean table (H01-H07, D05-D10,
J06-J09).

A view suite is a ``dict[str, DataFrame]`` of lazy plans over one base. Every sort
ends with the unique key, so ties are deterministic. Top-k uses ``orderBy().limit``
(``TakeOrderedAndProject``: a per-partition top-k, then a merge of k rows per
partition -- never a full sort). Full sorted views are range-partitioned sorts;
written with ``write_views`` the order survives in the part files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.functions.classify import contains_ci
from gleanspark.session import checkpoint_dir


def order_cols(by, key: str | None) -> list[Column]:
    """``by`` = [(column, 'asc'|'desc')...]; descending sorts put NULLs last (H03),
    ascending ones NULLs last too (pandas' default); ``key`` is appended."""
    out = []
    for c, d in by:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if d == "desc" else col.asc_nulls_last())
    if key:
        out.append(F.col(key).asc_nulls_last())
    return out


def sort_view(df: DataFrame, by, key: str | None = "url") -> DataFrame:
    """H01-H03."""
    return df.orderBy(*order_cols(by, key))


def ranked(df: DataFrame, by, key: str | None = "url", rank_col: str = "rank") -> DataFrame:
    """H01-H03 as a column: 1-based place of each row in the sort.

    Rows are dealt by range of the sort columns and counted per range; a row's place is the
    rows of the ranges before (a window over as many rows as partitions) plus its place in
    its own range, so no task holds all rows. Ties on all sort columns share no place; the
    ``key`` makes them distinct.
    """
    checkpoint_dir(df.sparkSession)
    order = order_cols(by, key)
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (dealt.withColumn("_place", place).join(base, "_range")
            .withColumn(rank_col, (F.col("_base") + F.col("_place")).cast("long"))
            .drop("_range", "_place", "_base"))


def top_k(df: DataFrame, by, k: int, key: str | None = "url") -> DataFrame:
    """The first ``k`` rows of the sort (the limit is the feature)."""
    return df.orderBy(*order_cols(by, key)).limit(k)


def band_views(df: DataFrame, col: str, lo: float, hi: float, key: str = "url",
               sort: bool = True) -> dict[str, DataFrame]:
    """``< lo``, ``[lo, hi]`` (both ends inclusive), ``> hi``."""
    c = F.col(col)
    views = {"under": df.filter(c < lo), "between": df.filter((c >= lo) & (c <= hi)),
             "above": df.filter(c > hi)}
    if sort:
        views = {k: sort_view(v, [(col, "asc")], key) for k, v in views.items()}
    return views


def keyword_view(df: DataFrame, col: str, keyword: str) -> DataFrame:
    """lower(col) contains the keyword; NULL never matches."""
    return df.filter(contains_ci(col, keyword))


def regex_view(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """lower(col) matches the alternation; NULL never matches."""
    return df.filter(F.coalesce(F.lower(F.col(col)).rlike(pattern), F.lit(False)))


def value_counts(df: DataFrame, col: str, count_name: str = "Count") -> DataFrame:
    """count per value, NULL excluded, descending count then value (tie-break by
    value). Partial aggregation makes a hot value cheap."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.col(count_name).desc(), F.col(col).asc()))


def columns_last(df: DataFrame, last: tuple[str, ...]) -> DataFrame:
    """One projection that puts the named columns, where present, at the end."""
    tail = [F.col(c) for c in last if c in df.columns]
    return df.select(*(c for c in df.columns if c not in last), *tail)


def move_before(df: DataFrame, col: str, before: str) -> DataFrame:
    """Put ``col`` right before ``before``."""
    cols = [c for c in df.columns if c != col]
    i = cols.index(before)
    return df.select(*cols[:i], col, *cols[i:])


@dataclass(frozen=True)
class View:
    """Rows of ``base`` where ``where`` holds, in the order ``by`` (then ``key``), the first
    ``limit`` of them."""
    base: DataFrame
    where: Column | None = None
    by: tuple = ()
    limit: int | None = None
    key: str | None = "url"

    def frame(self) -> DataFrame:
        df = self.base if self.where is None else self.base.filter(self.where)
        if self.limit is not None:
            return top_k(df, self.by, self.limit, self.key)
        return sort_view(df, self.by, self.key) if self.by else df


class ViewSuite(Mapping):
    """A named set of views, each a ``View`` or a function that makes a frame, built on first
    access (a DataFrame is analyzed when it is built, so building all views to read one is
    wasted planning)."""

    def __init__(self, builders: dict):
        self._builders = builders
        self._built: dict = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            b = self._builders[name]
            self._built[name] = b.frame() if isinstance(b, View) else b()
        return self._built[name]

    def definition(self, name: str) -> View | None:
        """The view as data, where it is a ``View``."""
        b = self._builders[name]
        return b if isinstance(b, View) else None

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


# The view parameters of the product search suite and bookstore suite.
SEARCH_BANDS = (100, 300)
SEARCH_KEYWORDS = {"Gel Pen": "gel pen", "Ball Pen": "ball pen", "Kawaii": "kawaii",
                   "Sanrio": "sanrio"}
BOOK_BANDS = (200, 500)
BOOK_REGEX = {"Quran": "কুরআন|quran|qur'an", "Hadith": "হাদিস|hadith"}
TOP_K = 50
PLACE_TOP_K = 10


def _there(*cols: str) -> Column:
    """What ``na.drop`` keeps: no NULL and no NaN."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & ~F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(False))
    return out


def value_views(final: DataFrame) -> ViewSuite:
    """Combined, Cheapest, Top Rated, Best Value."""
    return ViewSuite({
        "Combined": View(final),
        "Cheapest": View(final, _there("price_num"), (("price_num", "asc"),)),
        "Top Rated": View(final, _there("rating_score"), (("rating_score", "desc"), ("rating_count", "desc"))),
        "Best Value": View(final, _there("value_score"), (("value_score", "desc"),)),
    })


def _bands(col: str, lo: float, hi: float) -> dict[str, Column]:
    c = F.col(col)
    return {f"Under {lo}": c < lo, f"{lo} to {hi}": (c >= lo) & (c <= hi), f"Above {hi}": c > hi}


def product_views(raw: DataFrame, clean: DataFrame, bands=SEARCH_BANDS,
                  keywords=SEARCH_KEYWORDS, k: int = TOP_K) -> ViewSuite:
    """The 12-view search suite over one clean table."""
    cheap = (("price_num", "asc"),)
    b = {"Raw": View(raw), "Clean": View(clean), "Cheapest": View(clean, by=cheap),
         "Most Expensive": View(clean, by=(("price_num", "desc"),))}
    b |= {name: View(clean, where) for name, where in _bands("price_num", *bands).items()}
    b |= {label: View(clean, contains_ci("name", kw)) for label, kw in keywords.items()}
    b[f"Top Cheapest {k}"] = View(clean, by=cheap, limit=k)
    return ViewSuite(b)


def book_views(raw: DataFrame, clean: DataFrame, bands=BOOK_BANDS, regexes=BOOK_REGEX,
               k: int = TOP_K) -> ViewSuite:
    """The 12-view bookstore suite."""
    priced, cheap = _there("current_price_num"), (("current_price_num", "asc"),)
    b = {"Raw": View(raw), "Clean": View(clean), "Cheapest": View(clean, priced, cheap),
         "Most Expensive": View(clean, priced, (("current_price_num", "desc"),)),
         "Top Rated": View(clean, _there("ratings_count"), (("ratings_count", "desc"),))}
    b |= {name: View(clean, priced & where, cheap) for name, where in _bands("current_price_num", *bands).items()}
    b |= {label: View(clean, F.coalesce(F.lower("title").rlike(rx), F.lit(False))) for label, rx in regexes.items()}
    b[f"Top Cheapest {k}"] = View(clean, priced, cheap, k)
    b["Best Books Recommended"] = lambda: sort_view(best_books(clean), [("score", "desc")])
    return ViewSuite(b)


def best_books(clean: DataFrame) -> DataFrame:
    """D09 + C38: ratings_count >= 5 and price > 0, score = count / price."""
    ok = clean.filter((F.col("ratings_count") >= 5) & (F.col("current_price_num") > 0))
    return ok.withColumn("score", F.col("ratings_count").cast("double") / F.col("current_price_num"))


def place_views(raw: DataFrame, clean: DataFrame, k: int = PLACE_TOP_K,
                key: str = "id") -> ViewSuite:
    """The 9-view place suite."""
    lv, rating, count = F.col("price_level"), ("rating", "desc"), ("rating_count", "desc")
    return ViewSuite({
        "Raw": View(raw, key=key), "Clean": View(clean, key=key),
        "Cheapest": View(clean, lv.isin("Free", "Cheap"), (rating,), k, key),
        "Premium": View(clean, lv.isin("Expensive", "Very Expensive"), (rating,), k, key),
        "Top Rated": View(clean, None, (rating, count), k, key),
        "Most Reviewed": View(clean, None, (count,), k, key),
        "Best Valued": View(clean, None, (("value_score", "desc"),), k, key),
        "Website Analysis": lambda: value_counts(clean, "website_type"),
        "Area Analysis": lambda: value_counts(clean, "area"),
    })


def preview(df: DataFrame, by, n: int = 10, key: str | None = "url") -> DataFrame:
    """The first ``n`` rows in order (a look at the data; the limit is the feature)."""
    return top_k(df, by, n, key)
