"""Stored tables in buckets of their key.

A daily run joins what is new with what is stored. Kept in buckets of ``url``, the stored side
of an anti join, join or keep-first is read bucket by bucket: only the new rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """``df`` as the external table ``table`` at ``path``, in ``buckets`` buckets of ``key``,
    each sorted by it. Rows meet their bucket in one shuffle, so a bucket is one file a write."""
    (df.repartition(buckets, key).write.mode(mode).format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def open_bucketed(spark: SparkSession, table: str, path: str, schema: T.StructType, key: str,
                  buckets: int) -> DataFrame:
    """The table; a session whose catalog does not know it yet is told where it lies."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
