"""Table scans."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_SCANS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table: ``<sf_dir>/<name>.parquet``. Filters and projections written
    after this reach the parquet scan (``PushedFilters`` / ``ReadSchema``).

    The driver tables are read-only, so the scan (file listing and footer schema) is
    resolved once per session and path; a DataFrame is an immutable plan and is
    safely reused by every query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _SCANS[key] = df
    return df


TEXT_PARTITIONS = "spark.gleanspark.textPartitions"


def heavy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table whose rows are large texts (``pages``, ``documents``). Its parallelism is
    the scan's; a caller whose files cannot be split may set ``spark.gleanspark.textPartitions``
    to deal the rows out to that many partitions."""
    df = table(spark, sf_dir, name)
    parts = spark.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The dataset at ``path`` with a fixed schema, or an empty frame of that
    schema when nothing is stored yet. Works for any Hadoop file system."""
    if path and (_exists(spark, path) if "://" in path else os.path.exists(path) or _exists(spark, path)):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
