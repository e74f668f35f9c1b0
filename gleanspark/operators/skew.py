"""Joins on keys of which some are very frequent.

``heavy_hitters`` measures the key column of the large side with a frequency sketch that is
merged over partitions, and ``salted_join`` deals the rows of each frequent key over as many
shares as its measured count needs. Only these keys are copied on the other side, each as
often as its shares; all other keys stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most frequent keys that are dealt, and counters of the sketch: a key is missed only if it
#: holds less than about one row in ``TRACKED`` of the table, which is no hot key.
HEAVY, TRACKED = 256, 16_384


def heavy_hitters(df: DataFrame, key: str, rows_per_share: int) -> dict[str, int]:
    """Frequent values of a string column -> shares: its count by ``rows_per_share``, at least
    2. One aggregate with a fixed-size state; at most ``HEAVY`` entries come back."""
    found = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {HEAVY}, {TRACKED})").alias("top")).first()
    out = {}
    for r in (found["top"] if found and found["top"] else []):
        if r["count"] > rows_per_share:
            out[r["item"]] = -(-int(r["count"]) // rows_per_share)
    return out


def _shares(key: Column, heavy: dict[str, int]) -> Column:
    if not heavy:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for kv in heavy.items() for x in kv])
    return F.coalesce(F.try_element_at(table, key), F.lit(1))


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left",
                rows_per_share: int = 100_000, heavy: dict[str, int] | None = None) -> DataFrame:
    """``left`` joined with ``right`` on the string column ``key``; rows of ``left`` with a
    frequent key are dealt by the hash of ``spread``, a column with many values.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. The rows are those of the
    plain join. ``heavy`` may be given where it is known.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"how = {how!r}: the salted side has to be the left one")
    heavy = heavy_hitters(left, key, rows_per_share) if heavy is None else heavy
    if not heavy:
        return left.join(right, key, how)
    dealt = left.withColumn("_share", F.pmod(F.xxhash64(spread), _shares(F.col(key), heavy)).cast("int"))
    copies = right.withColumn("_share", F.explode(F.sequence(F.lit(0), _shares(F.col(key), heavy) - 1)))
    return dealt.join(copies, [key, "_share"], how).drop("_share")
