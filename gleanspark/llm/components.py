"""Connected components of links by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable, for every id of ``links`` (a, b).

    Each round points the larger neighbours of a node, then the smaller ones, to the
    smallest; the number of rounds is logarithmic in the longest path. Each round is
    written to the shared folder; only two numbers come back to the driver.
    """
    edges = materialize(links.filter("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u and v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "edges")
        row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (row[0], row[1]) == before:
            break
        before = (row[0], row[1])
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
