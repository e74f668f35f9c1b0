
from pyspark.sql import functions as F

from gleanspark.operators import views
from gleanspark.operators.dedup import drop_exact_duplicates, keep_first, union_keep_stored


def test_keep_first_by_page_and_pos(spark):
    df = spark.createDataFrame([("a", 1, 2, "p1"), ("a", 2, 0, "p2"), ("b", 3, 1, "x")],
                               "url string, page int, pos int, v string")
    got = sorted(tuple(r) for r in keep_first(df, "url", ["page", "pos"]).collect())
    assert got == [("a", 1, 2, "p1"), ("b", 3, 1, "x")]


def test_keep_first_independent_of_partitioning(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"),
                                     (F.col("id") * 3).alias("v"))
    a = sorted(tuple(r) for r in keep_first(df.repartition(1), "k", ["o"]).collect())
    b = sorted(tuple(r) for r in keep_first(df.repartition(13, "v"), "k", ["o"]).collect())
    assert a == b and len(a) == 7 and all(r[1] == r[0] for r in a)


def test_hot_key_keep_first(spark):
    """A third of all rows on one key still gives one row and the right one."""
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      (30000 - F.col("id")).alias("o"))
    out = keep_first(df, "k", ["o"])
    assert out.filter("k = 0").collect()[0]["o"] == 3
    assert out.count() == 20001


def test_validate_then_dedup_vs_dedup_then_validate(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, "ok")], "url string, pos int, name string")
    valid_first = keep_first(df.filter(F.col("name").isNotNull()), "url", ["pos"])
    seen_first = keep_first(df, "url", ["pos"]).filter(F.col("name").isNotNull())
    assert valid_first.count() == 1 and seen_first.count() == 0


def test_null_safe_four_column_dedup(spark):
    df = spark.createDataFrame([("n", "a", None, "c"), ("n", "a", None, "c"), ("n", "a", "1", "c")],
                               "name string, address string, phone string, category string")
    assert drop_exact_duplicates(df, ["name", "address", "phone", "category"]).count() == 2


def test_stored_wins(spark):
    stored = spark.createDataFrame([("a", 1.0)], "url string, price double")
    new = spark.createDataFrame([("a", 2.0), ("b", 3.0)], "url string, price double")
    got = sorted(tuple(r) for r in union_keep_stored(stored, new, "url").collect())
    assert got == [("a", 1.0), ("b", 3.0)]


def test_left_join_keeps_listing_rows(spark):
    from gleanspark.plans.products import final_products
    lst = spark.createDataFrame([(1, "a", "৳ 1", 1.0, "u/a"), (1, "b", "৳ 2", 2.0, "u/b")],
                                "page int, name string, price string, price_num double, url string")
    det = spark.createDataFrame([("u/a", 4.0, 10, 1, "B", "S", "D", True)],
                                "url string, rating_score double, rating_count long, answered_questions long, "
                                "brand string, seller string, description string, extract_ok boolean")
    got = {r.url: r for r in final_products(lst, det).collect()}
    assert got["u/b"].rating_score is None and got["u/b"].value_score is None
    assert round(got["u/a"].value_score, 6) == 4.4


def test_bands_partition_the_table(spark):
    df = spark.createDataFrame([(99.99, "a"), (100.0, "b"), (300.0, "c"), (300.01, "d"), (None, "e")],
                               "price_num double, url string")
    b = views.band_views(df, "price_num", 100, 300)
    assert [r.url for r in b["under"].collect()] == ["a"]
    assert [r.url for r in b["between"].collect()] == ["b", "c"]
    assert [r.url for r in b["above"].collect()] == ["d"]


def test_top10_nulls_last(spark):
    rows = [(f"r{i}", float(i)) for i in range(3)] + [(f"n{i}", None) for i in range(9)]
    df = spark.createDataFrame(rows, "id string, rating double")
    got = [r.id for r in views.top_k(df, [("rating", "desc")], 10, key="id").collect()]
    assert got[:3] == ["r2", "r1", "r0"] and len(got) == 10 and got[3:] == [f"n{i}" for i in range(7)]


def test_value_counts_tie_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b",), (None,)], "t string")
    assert [tuple(r) for r in views.value_counts(df, "t").collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_first_empty_page(spark):
    from gleanspark.plans.sites import stop_at_first_empty
    counts = [3, 2, 0, 4]
    rows = [("q", p, i) for p, n in enumerate(counts) for i in range(n)]
    df = spark.createDataFrame(rows, "query string, page int, i int")
    frontier = spark.createDataFrame([("q", p) for p in range(4)], "query string, page int")
    assert stop_at_first_empty(df, frontier).count() == 5


def test_page_chain(spark):
    from gleanspark.operators.chain import chain_order
    edges = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", None), ("4", None), ("7", "8"), ("8", "7")],
                                  "url string, next_url string")
    got = sorted(tuple(r) for r in chain_order(edges).collect())
    assert got == [("1", 0, "1"), ("1", 1, "2"), ("1", 2, "3"), ("4", 0, "4")]


def test_page_chain_merges_and_cycles(spark):
    import pytest

    from gleanspark.operators.chain import chain_order
    edges = spark.createDataFrame([("H1", "X"), ("H2", "X"), ("X", "Y"), ("Y", None), ("T", "A"), ("A", "B"), ("B", "A")],
                                  "url string, next_url string")
    starts = spark.createDataFrame([("H1",), ("H2",), ("T",), ("alone",), (None,)], "url string")
    got = sorted(tuple(r) for r in chain_order(edges, starts).collect())
    assert got == [("H1", 0, "H1"), ("H1", 1, "X"), ("H1", 2, "Y"), ("H2", 0, "H2"), ("H2", 1, "X"), ("H2", 2, "Y"),
                   ("T", 0, "T"), ("T", 1, "A"), ("T", 2, "B"), ("alone", 0, "alone")]
    with pytest.raises(ValueError, match="merge"):
        chain_order(edges)


def test_long_chain_log_rounds(spark):
    from gleanspark.operators.chain import chain_order
    n = 300
    edges = spark.createDataFrame([(f"p{i}", f"p{i + 1}" if i < n - 1 else None) for i in range(n)],
                                  "url string, next_url string")
    got = {r.url: r.depth for r in chain_order(edges).collect()}
    assert len(got) == n and got["p0"] == 0 and got[f"p{n - 1}"] == n - 1


def test_segmented_frontier(spark):
    from gleanspark.sources.frontier import segmented_frontier
    seg = spark.createDataFrame([
        ("Restaurant", 1, "https://d/R/city", "https://d/R/{page}/city", 21),
        ("Vehicle", 2, "https://d/V/city", "https://d/V/{page}/city", 33)],
        "category string, seg_order int, first_url string, page_url string, n_pages int")
    got = {r.run_index: (r.category, r.url) for r in segmented_frontier(seg).collect()}
    assert got[1] == ("Restaurant", "https://d/R/city")
    assert got[2] == ("Restaurant", "https://d/R/2/city")
    assert got[22] == ("Vehicle", "https://d/V/city")
    assert got[23] == ("Vehicle", "https://d/V/2/city")
    assert len(got) == 54


def test_search_frontier_page_cap(spark):
    from gleanspark.sources.frontier import search_frontier
    q = spark.createDataFrame([("kawaii pen", 8), ("ink", 2)], "query string, n_pages int")
    rows = search_frontier(q, "https://s/?q={q}&page={page}", max_pages=5).collect()
    assert len(rows) == 7
    assert "https://s/?q=kawaii%20pen&page=5" in {r.url for r in rows}


def test_remaining_urls_retry(spark):
    from gleanspark.sources.frontier import remaining_urls
    lst = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    det = spark.createDataFrame([("a", True), ("b", False)], "url string, extract_ok boolean")
    assert sorted(r.url for r in remaining_urls(lst, det).collect()) == ["b", "c"]
    assert sorted(r.url for r in remaining_urls(lst, det, retry_failed=False).collect()) == ["c"]


def test_place_search_parse(spark):
    from gleanspark.plans.places import enrich, first_seen_places
    search = spark.createDataFrame([
        ("q1", 0, 0, '{"places":[{"id":"A","displayName":{"text":"Grill  One"},"rating":4.5},{"displayName":{"text":"noid"}}]}'),
        ("q2", 1, 0, '{"places":[{"id":"A","displayName":{"text":"Other"}},{"id":"B","formattedAddress":"x"}]}'),
        ("q2", 1, 1, '{"nextPageToken":"t"}')], "query string, query_idx int, page_idx int, body string")
    details = spark.createDataFrame([
        ("A", 200, '{"id":"A","nationalPhoneNumber":"","internationalPhoneNumber":"+1","priceLevel":"PRICE_LEVEL_MODERATE",'
                   '"priceRange":{"startPrice":{"currencyCode":"BDT","units":"2","nanos":125000000}}}'),
        ("B", 500, "{}")], "id string, status int, body string")
    got = {r.id: r for r in enrich(first_seen_places(search), details).collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].name, got["A"].phone, got["A"].price_level, got["A"].price_start) == \
        ("Grill  One", "+1", "Moderate", "BDT 2.12")
    assert got["B"].phone is None and got["B"].address == "x"
