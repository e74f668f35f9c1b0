"""Sinks (J01-J05, J10) and the run log."""

import os
import tempfile


from pyspark.sql import functions as F

from gleanspark.operators import views
from gleanspark.sources.sinks import (cards_per_page, run_summary, view_folder, write_table,
                                      write_views)
from gleanspark.sources.tables import read_if_exists


def test_write_views_and_read_back(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-views-")
    base = spark.createDataFrame([(1, "a", 3.0), (1, "b", 1.0), (2, "c", 2.0)],
                                 "page int, url string, price_num double")
    suite = {"Clean": base, "Cheapest": views.sort_view(base, [("price_num", "asc")]),
             "Top 1": views.top_k(base, [("price_num", "asc")], 1)}
    paths = write_views(suite, root, base=base)
    assert set(paths) == set(suite)
    back = spark.read.parquet(paths["Cheapest"]).orderBy("view_order")
    assert [r.url for r in back.collect()] == ["b", "c", "a"]
    assert spark.read.parquet(os.path.join(root, view_folder("Top 1"))).count() == 1


def test_skip_empty_and_csv(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-sink-")
    empty = spark.createDataFrame([], "url string")
    assert write_table(empty, os.path.join(root, "e")) is False
    assert not os.path.exists(os.path.join(root, "e"))
    df = spark.createDataFrame([("x", 1)], "name string, n int")
    assert write_table(df, os.path.join(root, "c"), fmt="csv")
    back = spark.read.option("header", True).csv(os.path.join(root, "c"))
    assert back.columns == ["name", "n"] and back.count() == 1


def test_read_if_exists(spark):
    missing = os.path.join(tempfile.mkdtemp(prefix="gleanspark-rie-"), "none")
    df = read_if_exists(spark, missing, spark.createDataFrame([], "url string").schema)
    assert df.count() == 0 and df.columns == ["url"]


def test_run_log(spark):
    rows = spark.createDataFrame([(0, "a"), (0, "b"), (2, "a")], "page int, url string")
    pages = spark.createDataFrame([(0,), (1,), (2,)], "page int")
    assert [tuple(r) for r in run_summary(rows).collect()] == [(3, 2, 2)]
    assert sorted(tuple(r) for r in cards_per_page(rows, pages).collect()) == [(0, 2), (1, 0), (2, 1)]


def test_view_order_survives_many_partitions(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-order-")
    df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("v"),
                                                     F.col("id").cast("string").alias("url"))
    paths = write_views({"Sorted": views.sort_view(df.repartition(5), [("v", "desc")])}, root)
    back = [r.v for r in spark.read.parquet(paths["Sorted"]).orderBy("view_order").collect()]
    assert back == sorted(back, reverse=True) and len(back) == 5000


def test_suite_in_one_job(spark):
    """Every view of a base from one job, each equal to its query and in its order."""
    import tempfile

    from pyspark.sql import functions as F

    from gleanspark.operators import views
    from gleanspark.sources.sinks import write_suite

    base = spark.range(400).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.concat(F.lit("Gel Pen "), (F.col("id") % 7).cast("string")).alias("name"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 500).cast("double")).alias("price_num"))
    suite = views.product_views(base.select("name", "url"), base)
    paths = write_suite(suite, tempfile.mkdtemp(prefix="gleanspark-suite-") + "/out")
    assert set(paths) == set(suite) and len({p.rsplit("/view=", 1)[0] for p in paths.values()}) == 2     # one job a base
    for name, path in paths.items():
        got = spark.read.parquet(path).orderBy("view_order").drop("view_order")
        rows, want = [tuple(r) for r in got.select(*suite[name].columns).collect()], [tuple(r) for r in suite[name].collect()]
        by = suite.definition(name).by
        assert (rows == want) if by else (sorted(rows, key=str) == sorted(want, key=str)), name


def test_suite_query_reads_its_pages_once(spark, monkeypatch, tmp_path):
    """No view of suite_in_one_pass has the extraction from pages in its plan."""
    from gleanspark.sources import sinks
    from querybook.more import QUERIES
    seen, write = [], sinks.write_suite

    def looked_at(suite, root, **kw):
        seen.extend(suite[n]._jdf.queryExecution().optimizedPlan().toString() for n in suite)
        return write(suite, root, **kw)

    monkeypatch.setattr(sinks, "write_suite", looked_at)
    types = ("STANDARD", "ECONOMY", "PROMO", "LARGE", "SMALL", "MEDIUM")
    spark.createDataFrame([(k, f"part {k}", types[k % 6], "Brand#1", k % 50 + 1, 900.0 + k) for k in range(60)],
                          "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"
                          ).write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["suite_in_one_pass"](spark, str(tmp_path)).groupBy("view").count()
    assert {r["view"]: r["count"] for r in got.collect()}["cheapest"] == 40
    assert len(seen) == 12 and not any("Generate" in p or "Aggregate" in p for p in seen)
