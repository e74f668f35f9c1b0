"""Exact duplicates by progressive refinement (operator 9, Spark expressions only).

1. length of the normalised text: lengths seen once are unique;
2. hash of a short prefix, within a length: prefixes seen once are unique;
3. SHA-256 of the whole text, only for rows whose (length, prefix) group survives.

Steps 1 and 2 work on a narrow table (id, length, prefix hash). Every grouping is a
partial aggregate, so a hot length or a group of copies holding a third of the rows is
reduced to one row per input partition before it is shuffled. The text itself moves
once, to the join that finds the surviving rows; a skewed group is an ordinary join
partition there, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import WS, materialize


def normalised(text: Column) -> Column:
    """White-space runs as one space; null as empty. Single spaces are not touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WS}]{{2,}}+|[\\x09-\\x0D]", " ")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 128, digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the smallest id of the rows with an equal normalised text and
    ``kept`` says that this row has it. ``text_sha256`` (lowercase hex of the normalised
    UTF-8 text) is null for rows that steps 1 and 2 already show to be unique, unless
    ``digest_all`` asks for the digest of every row.

    Null text counts as empty, and empty texts are equal to each other. Rows that repeat
    an id are rows of their own in ``group_size`` and share one decision; a null id never
    represents a group that has an id, and a row without id is kept only if its whole
    group has none. Other columns are ignored; an empty table gives an empty table.
    """
    # both projections start at the scan; only `narrow` is stored
    base = df.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm"))
    keys = (F.octet_length("_norm").alias("_len"),
            F.xxhash64(F.substring("_norm", 1, prefix_chars)).alias("_prefix"))
    narrow = materialize(base.select(*keys), "lengths")
    # copies are counted before anything is joined: one row per (length, prefix)
    groups = narrow.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    lengths = groups.groupBy("_len").agg(F.sum("_n").alias("_all")).filter("_all > 1")
    prefixes = groups.join(lengths, "_len", "left_semi").filter("_n > 1")

    marked = base.select("_id", "_norm", *keys).join(
        prefixes.hint("shuffle_hash"), ["_len", "_prefix"], "left")
    alive = F.col("_n").isNotNull()
    sha = F.unhex(F.sha2(F.col("_norm").cast("binary"), 256))
    rows = materialize(marked.select(
        "_id", "_len", alive.alias("_alive"),
        (sha if digest_all else F.when(alive, sha)).alias("_sha")), "digests")

    copies = (rows.filter("_alive").groupBy("_len", "_sha")
              .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
              .filter("_size > 1").withColumn("_alive", F.lit(True)))
    out = rows.join(copies, ["_alive", "_len", "_sha"], "left")
    grouped = F.col("_size").isNotNull()
    keep = F.when(grouped, F.col("_keep")).otherwise(F.col("_id"))
    return out.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))
