"""Salted joins and bucketed tables: rows of the plain join, tasks and exchanges as promised."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from gleanspark.operators.skew import heavy_hitters, salted_join
from gleanspark.plans import places
from gleanspark.sources.bucketed import open_bucketed, write_bucketed


@pytest.fixture(scope="module")
def sides(spark):
    """A key that holds a third of the rows, many cold keys, null keys; keys without a partner."""
    left = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("key"))
    right = spark.range(0, 700, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v")) \
        .union(spark.createDataFrame([("hot", -1), ("hot", -2), ("none", -3)], "key string, v long"))
    return left, right


def test_frequent_keys_are_measured(spark, sides):
    left, right = sides
    assert heavy_hitters(left, "key", 500) == {"hot": 6} and heavy_hitters(left, "key", 5_000) == {}
    assert heavy_hitters(left.filter("false"), "key", 1) == {}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(spark, sides, how):
    left, right = sides
    got, want = salted_join(left, right, "key", "id", how, rows_per_share=500), left.join(right, "key", how)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_hot_rows_spread_and_cold_keys_are_not_copied(spark, sides):
    left, right = sides
    plan = salted_join(left, right, "key", "id", rows_per_share=500)._jdf.queryExecution().optimizedPlan().toString()
    assert "_share" in plan
    heavy = heavy_hitters(left, "key", 500)
    shares = left.filter("key = 'hot'").select(F.pmod(F.xxhash64("id"), F.lit(heavy["hot"])).alias("s")).groupBy("s").count()
    assert shares.count() == 6 and shares.agg(F.max("count")).first()[0] < 2 * 500 * 1.3


def test_places_of_one_website_keep_their_mail(spark):
    """A website that a third of the places name: same rows, dealt or not."""
    n = 300
    raw = spark.range(n).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("id"), F.lit("Cafe").alias("name"),
        F.lit("1 Road, Dhaka").alias("address"), F.lit("1").alias("phone"), F.lit(4.5).alias("rating"),
        F.lit(10).alias("rating_count"), F.lit("Cheap").alias("price_level"), F.lit(None).cast("string").alias("price_start"),
        F.lit(None).cast("string").alias("price_end"), F.lit("m").alias("maps_link"),
        F.when(F.col("id") % 3 == 0, F.lit("https://hot.example.org")).otherwise(
            F.concat(F.lit("https://s"), F.col("id").cast("string"), F.lit(".example.org"))).alias("website"))
    home = spark.createDataFrame([("https://hot.example.org", "write to a@hot.org"), ("https://s1.example.org", "b@one.org")],
                                 "url string, html string")
    shared = places.shared_sites(raw, rows=20)
    assert shared == {"https://hot.example.org": 5}
    a, b = places.clean_places(raw, home, shared), places.clean_places(raw, home)
    assert a.filter("email = 'a@hot.org'").count() == 100 and a.filter("email is null").count() == 199
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_bucketed_side_is_not_shuffled(spark):
    name, path = f"stored_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="gleanspark-buckets-") + "/t"
    stored = spark.range(5_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), "id")
    write_bucketed(stored, name, path, "url", 8)
    spark.sql(f"DROP TABLE {name}")                          # another session: the catalog does not know it
    kept = open_bucketed(spark, name, path, stored.schema, "url", 8)
    new = spark.range(4_900, 5_100).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, rows, exchanges in ((new.join(kept, "url", "left_anti"), 100, 1), (kept.join(new, "url", "left_semi"), 100, 1),
                                    (kept.groupBy("url").agg(F.min("id")), 5_000, 0)):
            assert df.count() == rows
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
