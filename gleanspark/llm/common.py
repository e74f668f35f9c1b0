"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.session import checkpoint_dir

#: The white space of the contracts, inside a regex class.
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/gleanspark-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and a
    table used twice is computed once. Only narrow intermediate tables go here.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes of whole texts that a Python worker is given at once.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def bounded_batches(df: DataFrame) -> None:
    """Called by operators whose Python code reads whole texts: smaller Arrow batches than
    Spark's default, so a worker's memory does not follow the length of the texts. Settings
    that the session has changed stay as they are."""
    conf = df.sparkSession.conf
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        if conf.get(name, None) is None:         # not set by the session
            conf.set(name, str(value))


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-white-space characters (0 for null).

    Each word, with the white space around it, becomes one mark; what is left of an
    all-blank text is removed. Possessive quantifiers: no backtracking on long texts.
    """
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WS}]*+[^{WS}]++[{WS}]*+", "x")
    return F.length(F.regexp_replace(marks, f"[{WS}]++", "")).cast("long")


def held_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null id: fold of '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds
