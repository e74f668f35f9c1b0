"""Page-chain traversal (B13, B14): the pages each start page leads to by ``next``.

Instead of following links one hop per step, every round doubles the distance a pointer
covers: after round k all pages within 2 ** k hops of a start are known, so a chain of
length L takes about log2 L rounds of two equi-joins. Rounds are checkpointed to the shared
folder; the walk of a start ends at its first repeated page, so cycles end too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.operators.dedup import keep_first
from gleanspark.session import checkpoint_dir


def chain_order(edges: DataFrame, starts: DataFrame | None = None, url: str = "url",
                next_url: str = "next_url") -> DataFrame:
    """``edges(url, next_url)`` -> ``(start_url, depth, url)``: one row per start and page it
    reaches, depth 0 being the start itself.

    ``starts(url)`` lists the start pages; chains that merge give the shared pages to each
    of their starts. Without it the starts are the pages no other page links to, and a
    page with several predecessors is an error (every head times every page could be
    asked for). A page with several ``next`` links follows the smallest.
    """
    checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col(url).alias("u"), F.col(next_url).alias("v"))
    linked = e.filter(F.col("u").isNotNull() & F.col("v").isNotNull())
    jump = keep_first(linked, "u", ["v"]).checkpoint()
    if starts is None:
        merged = jump.groupBy("v").count().filter("count > 1").limit(1).collect()
        if merged:
            raise ValueError(f"chains merge at {merged[0]['v']!r}: give the start pages")
        starts = e.select("u").filter("u is not null").distinct() \
            .join(jump.select(F.col("v").alias("u")), "u", "left_anti")
    else:
        starts = starts.select(F.col(url).alias("u")).filter("u is not null").distinct()
    seen = starts.select(F.col("u").alias("s"), "u", F.lit(0).cast("long").alias("depth")).checkpoint()
    hop, known = 1, -1
    while (now := seen.count()) != known:
        known = now
        ahead = seen.join(jump, "u").select("s", F.col("v").alias("u"), (F.col("depth") + hop).alias("depth"))
        seen = seen.unionByName(ahead).groupBy("s", "u").agg(F.min("depth").alias("depth")).checkpoint()
        far = jump.select(F.col("u").alias("v"), F.col("v").alias("w"))
        jump = jump.join(far, "v").select("u", F.col("w").alias("v")).checkpoint()
        hop *= 2
    return seen.select(F.col("s").alias("start_url"), "depth", F.col("u").alias(url))
