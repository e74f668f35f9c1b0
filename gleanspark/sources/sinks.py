"""Sinks and the run log."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanspark.sources.tables import _exists as exists


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                skip_empty: bool = True, partition_by: list[str] | None = None) -> bool:
    """J01 + J05: write one table; of an empty table nothing stays (returns False), neither
    files of this run nor, when overwriting, of the last. The rows are counted while they
    are written, so the plan runs once. CSV gets a header row (J03; UTF-8, no byte-order
    mark)."""
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    if skip_empty and seen.get["rows"] == 0:
        if mode == "overwrite":
            _delete(df.sparkSession, path)
        return False
    return True


def _delete(spark: SparkSession, path: str) -> None:
    """Remove the folder this writer has just made."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


# Column names readers see, where they differ from the tables' own.
DISPLAY_NAMES = {"win_pct": "Win %", "diff": "+/-", "area": "Area(km²)"}


def display_names(df: DataFrame, names: dict[str, str] = DISPLAY_NAMES) -> DataFrame:
    """C34 at the sink: columns under the names that readers see; others as they are."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def view_folder(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()


def write_views(views, root: str, fmt: str = "parquet",
                base: DataFrame | None = None, order_col: str | None = "view_order") -> dict[str, str]:
    """Every view of a suite to ``root/<view>/``. The shared ``base`` is
    persisted once for the suite and released after the last write.

    ``order_col`` keeps the order of sorted views: a sort range-partitions the rows,
    so ``monotonically_increasing_id`` (partition index, then row index) increases in
    sort order without any single-task window; readers ``orderBy(order_col)``.
    """
    if base is not None:
        base.persist()
    out = {}
    try:
        for name, df in views.items():
            path = f"{root.rstrip('/')}/{view_folder(name)}"
            if order_col:
                df = df.withColumn(order_col, F.monotonically_increasing_id())
            if write_table(df, path, fmt=fmt, skip_empty=False):
                out[name] = path
    finally:
        if base is not None:
            base.unpersist()
    return out


def write_suite(suite, root: str, fmt: str = "parquet", order_col: str = "view_order") -> dict[str, str]:
    """The views of a suite, those of one base in one job, to ``root/<base>/view=<view>/``;
    name -> folder.

    A row of the base carries the array of the views it belongs to, with its sort values in
    each; exploded, rows are dealt by range of (view, sort values) and written partitioned by
    view. So the base is read once, a large view spreads over tasks and files, and
    ``order_col`` rises in its order. Views with a limit come in as their first rows. Sort
    columns are numbers. Views that are no selection (counts, extra columns) have a job each.
    """
    groups, out = {}, {}
    for name in suite:
        view = suite.definition(name)
        groups.setdefault(id(view.base) if view else name, []).append(name)
    for g, names in enumerate(groups.values()):
        folder = f"{root.rstrip('/')}/{view_folder(names[0]) if len(names) == 1 else f'views_{g}'}"
        if len(names) == 1:
            df = suite[names[0]].withColumn(order_col, F.monotonically_increasing_id())
            write_table(df, folder, fmt=fmt, skip_empty=False)
            out[names[0]] = folder
        else:
            _write_group({n: suite.definition(n) for n in names}, folder, fmt, order_col)
            out |= {n: f"{folder}/view={view_folder(n)}" for n in names}
    return out


def _write_group(views: dict, folder: str, fmt: str, order_col: str) -> None:
    width = max(len(v.by) for v in views.values())
    first = next(iter(views.values()))

    def membership(name: str, view):
        keys = []
        for c, d in view.by:                                 # falling: negated; NULL stands last
            value = F.col(c).cast("double")
            keys += [F.col(c).isNull(), F.coalesce(-value if d == "desc" else value, F.lit(0.0))]
        keys += [F.lit(False), F.lit(0.0)] * (width - len(view.by))
        return F.struct(F.lit(view_folder(name)).alias("view"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])

    def rows_of(base: DataFrame, members: list) -> DataFrame:
        found = F.filter(F.array(*members), lambda m: m.isNotNull())
        return base.select("*", F.inline(found))

    whole = [F.when(F.lit(True) if v.where is None else v.where, membership(n, v))
             for n, v in views.items() if v.limit is None]
    parts = [rows_of(first.base, whole)] if whole else []
    parts += [rows_of(v.frame(), [membership(n, v)]) for n, v in views.items() if v.limit is not None]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    key = next((v.key for v in views.values() if v.by), None)
    order = ["view", *[f"_k{i}" for i in range(2 * width)], *([key] if key else [])]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn(order_col, F.monotonically_increasing_id()).drop(*order[1:2 * width + 1])
    w = dealt.write.mode("overwrite").partitionBy("view")
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(folder)
    for name in views:                                       # a view without rows is an empty table
        path = f"{folder}/view={view_folder(name)}"
        if not exists(rows.sparkSession, path):
            write_table(dealt.drop("view").limit(0), path, fmt=fmt, skip_empty=False)


def cards_per_page(rows: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """rows per page, zero for pages that gave none (left join from the pages)."""
    counts = rows.groupBy(page).agg(F.count(F.lit(1)).alias("cards"))
    return pages.select(page).distinct().join(counts, page, "left") \
        .select(page, F.coalesce("cards", F.lit(0)).cast("long").alias("cards"))


def run_summary(rows: DataFrame, key: str = "url", page: str = "page") -> DataFrame:
    """F07 + J10: one summary row -- rows, unique keys, pages with rows."""
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_distinct(F.col(key)).alias("unique_keys"),
                    F.count_distinct(F.col(page)).alias("pages"))


def distinct_values(rows: DataFrame, col: str) -> DataFrame:
    """distinct non-null values of a column."""
    return rows.select(col).na.drop().distinct()
