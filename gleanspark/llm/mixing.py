"""Mixing sources to target weights (operator 8).

1. Targets: sources in code-point order (null last) get weights; the whole size is shared
   by weight, a source is never asked for more than ``max_repeats`` times its size, and the
   excess goes to the others by weight until none is above.
2. Stream: the documents of a source, in the order of a seeded hash, are one stream of
   words, read up to ``max_repeats`` times over. The stream is cut into blocks of
   ``block_words`` words; a source's quota is the exact number of blocks up to its target,
   the last of them cut short.
3. Splitting tree: the vector of block quotas is split recursively between the two halves
   of the output shards by multivariate-hypergeometric draws, down to single shards.
4. Draw: a seeded bijection permutes the block numbers of each source; each shard owns a
   disjoint range of the permuted blocks, as long as its quota. Inside a shard blocks are
   ordered by a seeded hash (``order_key``).

Offsets in a stream need running sums. They are taken in two levels, hash buckets first
and documents within a bucket second, so a source holding most rows is spread over
``buckets`` groups. Only one row per source reaches the driver, checked against
``max_sources``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import materialize, word_count


def targets(sizes: dict, weights: tuple = (1, 2, 3), max_repeats: int = 3) -> dict:
    """Target size of each source: {source: float}. ``weights`` repeat over the sources."""
    order = sorted(sizes, key=lambda s: (s is None, s))      # str order is code-point order
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, out = float(sum(sizes.values())), {}
    free = [s for s in order if sizes[s] > 0]
    out.update({s: 0.0 for s in order if sizes[s] <= 0})
    while free:
        rest = total - sum(out.values())
        unit = rest / sum(w[s] for s in free)
        above = [s for s in free if unit * w[s] > max_repeats * sizes[s]]
        if not above:
            out.update({s: unit * w[s] for s in free})
            break
        out.update({s: float(max_repeats * sizes[s]) for s in above})
        free = [s for s in free if s not in out]
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Draw of ``n`` out of ``good + bad``: how many good. Any size: the probabilities are
    summed in logarithms over twelve standard deviations around the mode."""
    lo, hi = max(0, n - bad), min(good, n)
    if lo == hi:
        return lo
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    sd = math.sqrt(n * (good / total) * (bad / total) * max(total - n, 1) / max(total - 1, 1))
    a, b = max(lo, mode - int(12 * sd) - 12), min(hi, mode + int(12 * sd) + 12)
    k = np.arange(a, b, dtype=np.float64)
    step = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logp = np.concatenate([[0.0], np.cumsum(step)])
    p = np.cumsum(np.exp(logp - logp.max()))
    return a + int(np.searchsorted(p, rng.random() * p[-1], side="right"))


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard, (shards, sources): exact column sums and shard
    totals that differ by one block at most."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(0, shards, [int(q) for q in quotas])]
    while todo:
        first, n, have = todo.pop()
        if n == 1:
            out[first] = have
            continue
        left = n // 2
        rng = np.random.default_rng([seed, first, n])        # a node's draw is its own
        # shard s of n gets floor((s + 1) * total / n) - floor(s * total / n) blocks
        need, rest, took = sum(have) * left // n, sum(have), []
        for q in have:
            took.append(hypergeometric(rng, q, rest - q, need))
            need, rest = need - took[-1], rest - q
        todo += [(first, left, took), (first + left, n - left, [h - t for h, t in zip(have, took)])]
    return out


def _bijection(quota: int, seed: int) -> tuple[int, int]:
    """(a, b) of i -> (a * i + b) mod quota, a bijection whose products fit 63 bits."""
    rng = np.random.default_rng([seed, quota])
    top = max(1, min(quota - 1, (2**62) // max(quota, 1)))
    a = int(rng.integers(1, top + 1))
    while math.gcd(a, quota) != 1:
        a = a % top + 1
    return a, int(rng.integers(0, max(quota, 1)))


def source_plan(df: DataFrame, sized: DataFrame, weights: tuple, max_repeats: int, shards: int,
                block_words: int, seed: int, max_sources: int) -> DataFrame:
    """One row per source: size, target, words to take, bijection and shard bounds."""
    spark = df.sparkSession
    rows = (sized.groupBy("_source").agg(F.sum("_size").alias("n")).limit(max_sources + 1).collect())
    if len(rows) > max_sources:
        raise ValueError(f"over {max_sources} sources: raise max_sources if the driver can hold them")
    sizes = {r["_source"]: int(r["n"]) for r in rows}
    want = targets(sizes, weights, max_repeats)
    order = sorted(sizes, key=lambda s: (s is None, s))
    words = [min(round(want[s]), max_repeats * sizes[s]) for s in order]
    quotas = [-(-w // block_words) for w in words]
    bounds = np.cumsum(split_quotas(quotas, shards, seed), axis=0).T      # (sources, shards)
    plan = []
    for i, s in enumerate(order):
        a, b = _bijection(quotas[i], seed + i)
        plan.append((s, sizes[s], float(want[s]), words[i], quotas[i], a, b,
                     [int(x) for x in bounds[i]]))
    return spark.createDataFrame(
        plan, "_source string, source_size long, target double, _words long, _quota long, "
              "_a long, _b long, _bounds array<long>")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = (1, 2, 3), max_repeats: int = 3, shards: int = 64,
        block_words: int = 1024, seed: int = 7, buckets: int = 1024,
        max_sources: int = 100_000) -> DataFrame:
    """The drawn pieces: ``id_col, size, source_size, target, repeat, first_word, n_words,
    block, shard, order_key, stream_at``; one row per document, reading (``repeat``) and block.

    Words ``first_word .. first_word + n_words`` of the document belong to ``block`` of its
    source, which ``shard`` owns; a shard file is its rows sorted by
    (order_key, block, stream_at); ``stream_at`` is the place in the source's stream.
    A document nothing is taken from has one row with ``n_words`` 0 and a null block.

    Null text has size 0 and is never drawn. A null source is a source, last in order. Rows
    that repeat an id are separate documents with the same hash; their order is free, their
    sizes are equal only if their texts are. Other columns are ignored, an empty table gives
    an empty table. The same rows give the same result in any partitioning.
    """
    hashed = F.xxhash64(F.lit(seed), F.col("_id"))
    sized = materialize(df.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
        word_count(F.col(text_col)).alias("_size")).withColumn("_h", hashed)
        .withColumn("_bucket", F.pmod("_h", F.lit(buckets))), "sizes")
    # a fixed-size row per source: the bound is max_sources, checked in source_plan
    plan = source_plan(df, sized, weights, max_repeats, shards, block_words, seed, max_sources)

    # offsets: bucket totals first (buckets rows per source), documents within a bucket second
    by_bucket = (sized.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_n"))
                 .withColumn("_before", F.sum("_n").over(
                     Window.partitionBy("_source").orderBy("_bucket")) - F.col("_n"))
                 .select(F.col("_source").alias("_s"), F.col("_bucket").alias("_k"), "_before"))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_h", "_id", "_size")
    placed = (sized.withColumn("_in", F.sum("_size").over(
                  inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
              .join(by_bucket, F.col("_source").eqNullSafe(F.col("_s"))
                    & (F.col("_bucket") == F.col("_k")))
              .withColumn("_at", F.col("_before") + F.col("_in")).drop("_s", "_k"))
    drawn = placed.join(plan.withColumnRenamed("_source", "_s"),
                        F.col("_source").eqNullSafe(F.col("_s")))

    def start(e):                                            # of reading e, in the endless stream
        return F.col("_at") + e * F.col("source_size")

    readings = F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)),
                        lambda e: (F.col("_size") > 0) & (start(e) < F.col("_words")))
    per_reading = drawn.withColumn("repeat", F.explode_outer(readings))
    lo = F.col("_at") + F.col("repeat") * F.col("source_size")
    hi = F.least(lo + F.col("_size"), F.col("_words"))
    w = F.lit(block_words)
    per_block = (per_reading.withColumn("_lo", lo).withColumn("_hi", hi)
                 .withColumn("block", F.explode_outer(F.when(
                     F.col("repeat").isNotNull(),
                     F.sequence(F.expr(f"_lo div {block_words}"),
                                F.expr(f"(_hi - 1) div {block_words}"))))))
    first = F.greatest(F.col("_lo"), F.col("block") * w)
    last = F.least(F.col("_hi"), (F.col("block") + 1) * w)
    position = (F.col("block") * F.col("_a") + F.col("_b")) % F.col("_quota")
    shard = F.size(F.filter("_bounds", lambda b: b <= position))
    return per_block.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target",
        "repeat", (first - F.col("_lo")).alias("first_word"),
        F.coalesce(last - first, F.lit(0)).cast("long").alias("n_words"), "block",
        F.when(F.col("block").isNotNull(), shard).alias("shard"),
        F.when(F.col("block").isNotNull(),
               F.xxhash64(F.lit(seed), shard, F.col("_source"), F.col("block"))).alias("order_key"),
        F.when(F.col("block").isNotNull(), first).alias("stream_at"))


def write_shards(pieces: DataFrame, path: str) -> None:
    """Each shard's pieces in their shuffled order, one folder per shard."""
    (pieces.filter("block is not null").repartition("shard")
     .sortWithinPartitions("shard", "order_key", "block", "stream_at")
     .write.partitionBy("shard").parquet(path))
