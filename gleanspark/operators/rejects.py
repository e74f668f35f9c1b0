"""Reject channel of strict rules.

A strict rule stops a job at the first bad value. The other way is to go on with the good
rows and to hand out the bad ones with the reason: ``with_reason`` marks every row in the
pass that reads it, and ``split`` parts what it marked. Reject tables of all jobs have the
columns ``page, pos, reason``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions._util import col_of

REASON = "reason"


def with_reason(df: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """``df`` with ``reason``: the texts of all rules that a row breaks, in order, joined by
    '; '; NULL if it breaks none. A NULL condition is not broken."""
    parts = [F.when(F.coalesce(c, F.lit(False)), F.lit(text)) for text, c in broken.items()]
    return df.withColumn(REASON, F.nullif(F.concat_ws("; ", *parts), F.lit("")))


def split(df: DataFrame, page: str = "page") -> tuple[DataFrame, DataFrame]:
    """(good rows, reject table) of a frame with ``reason``."""
    pos = F.col("pos").cast("int") if "pos" in df.columns else F.lit(None).cast("int")
    return (df.filter(F.col(REASON).isNull()).drop(REASON),
            df.filter(F.col(REASON).isNotNull()).select(
                F.col(page).cast("string").alias("page"), pos.alias("pos"), REASON))


def not_a(c, to: str) -> Column:
    """Text that C10's strict cast would stop at."""
    txt = F.trim(col_of(c))
    return txt.isNotNull() & txt.try_cast(to).isNull()


def lenient(c, to: str) -> Column:
    """C10 without the stop: bad text is NULL."""
    return F.trim(col_of(c)).try_cast(to)
