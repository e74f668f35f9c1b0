"""Scores (C35-C38). Every division is guarded, so ANSI mode never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions._util import col_of
from gleanspark.functions.classify import PRICE_LEVEL_NUM
from gleanspark.functions.numbers import map_lookup


def value_score(rating, count, price) -> Column:
    """``rating * (1 + coalesce(count, 0) / 100) / price`` when price > 0 and
    rating is known; else NULL."""
    r, n, p = col_of(rating), col_of(count), col_of(price)
    return F.when((p > 0) & r.isNotNull(),
                  r * (F.lit(1.0) + F.coalesce(n, F.lit(0)).cast("double") / 100.0) / p)


def level_score(rating, level_label) -> Column:
    """Rating / level number; NULL if either is missing or the level is 0 (Free)."""
    num = map_lookup(level_label, PRICE_LEVEL_NUM)
    r = col_of(rating)
    return F.when(r.isNotNull() & (num > 0), r / num.cast("double"))
