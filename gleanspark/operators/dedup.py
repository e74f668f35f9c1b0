"""Keep-first deduplication.

``keep_first`` picks, per key, the row with the smallest order tuple. It is written
as ``groupBy(key).agg(min(struct(order..., rest...)))``: the aggregate is partial
(map-side) so a hot key that holds a third of all rows is reduced to one row per
input partition before the shuffle, and no task ever holds the whole group. A
window ``row_number() = 1`` would sort the whole hot group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (column names or Column expressions,
    ascending). Expression order keys rank rows but are not output.

    NULL keys group together (as ``drop_duplicates`` does). Ties on the whole order
    tuple fall back to the remaining columns, so the result is deterministic.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    names = [o for o in order if isinstance(o, str)]
    rest = [c for c in df.columns if c not in keys and c not in names]
    packed = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)],
                      *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    out = agg.select(*keys, *[F.col("_first")[f"_o{i}"].alias(o) for i, o in enumerate(order)
                              if isinstance(o, str)],
                     *[F.col("_first")[c].alias(c) for c in rest])
    return out.select(*df.columns)


def drop_exact_duplicates(df: DataFrame, cols=None) -> DataFrame:
    """rows equal on ``cols`` (NULL equals NULL) collapse to one. Exact keep-first
    when ``cols`` are all the columns; partial aggregation makes it skew-safe."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def union_keep_stored(stored: DataFrame, new: DataFrame, keys, order=()) -> DataFrame:
    """Stored rows win over new ones with the same key; then keep-first by
    ``order`` inside each generation."""
    s = stored.withColumn("_gen", F.lit(0))
    n = new.withColumn("_gen", F.lit(1))
    u = s.unionByName(n, allowMissingColumns=True)
    return keep_first(u, keys, ["_gen", *order]).drop("_gen")
