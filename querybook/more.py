"""More registered queries: the order of sorted views, sinks read back, guards and caps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanspark.operators import views
from gleanspark.plans import sites
from gleanspark.session import scratch_path
from gleanspark.sources.tables import heavy_table, read_if_exists, table
from querybook import render
from querybook.catalog import _BOOK_CTE, _TEAM_SQL, ORACLE, QUERIES, _book_view, register

# ---------------------------------------------------------------------------
# Sorted views carry the place of each row, so their order is compared

register("book_cheapest", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE current_price_num IS NOT NULL")(
    _book_view("Cheapest"))

_PRICE, _BOOK = [("price_num", "asc")], [("current_price_num", "asc")]
SORTED = {
    "search_cheapest": _PRICE, "search_most_expensive": [("price_num", "desc")],
    "search_top_cheapest_50": _PRICE, "top_cheapest": _PRICE,
    "value_views_cheapest": _PRICE,
    "value_views_top_rated": [("rating_score", "desc"), ("rating_count", "desc")],
    "value_views_best_value": [("value_score", "desc")],
    "book_cheapest": _BOOK, "book_most_expensive": [("current_price_num", "desc")],
    "book_top_rated": [("ratings_count", "desc")], "book_under_200": _BOOK, "book_200_to_500": _BOOK,
    "book_above_500": _BOOK, "book_top_cheapest_50": _BOOK, "book_best": [("score", "desc")],
}


def _with_rank(name: str, by: list) -> None:
    plain = QUERIES[name]

    def fn(spark, sf):
        return views.ranked(plain(spark, sf), by)

    fn.__doc__ = f"{plain.__doc__ or name} The place of each row in the sort is column rank."
    order = ", ".join(f"{c} {d.upper()} NULLS LAST" for c, d in by) + ", url"
    register(f"{name}_ranked",
             f"SELECT q.*, row_number() OVER (ORDER BY {order}) AS rank FROM ({ORACLE[name]}) q")(fn)


for _name, _by in SORTED.items():
    _with_rank(_name, _by)


# ---------------------------------------------------------------------------
# Sinks, written and read back

def _folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _stored(spark, name, df):
    """``df`` written under the shared folder and read back."""
    path = _folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@register("sink_parquet", f"SELECT * FROM ({_TEAM_SQL}) t")
def q_sink_parquet(spark, sf):
    """J01 + A08: team rows written as one table and read back with a fixed schema."""
    from gleanspark.sources.sinks import write_table
    rows = sites.team_table(render.team_pages(table(spark, sf, "supplier")))
    path = _folder(spark, "sink")
    write_table(rows, path)
    return read_if_exists(spark, path, rows.schema)


@register("sink_csv", f"""
SELECT name AS "Team Name", win_pct AS "Win %", diff AS "+/-" FROM ({_TEAM_SQL}) t""")
def q_sink_csv(spark, sf):
    """J03 + C34: display names and CSV with a header, read back."""
    from gleanspark.sources.sinks import display_names, write_table
    rows = sites.team_table(render.team_pages(table(spark, sf, "supplier"))).select("name", "win_pct", "diff")
    shown = display_names(rows).withColumnRenamed("name", "Team Name")
    path = _folder(spark, "csv")
    write_table(shown, path, fmt="csv")
    return spark.read.option("header", True).schema(shown.schema).csv(path)


@register("sink_views", f"""
WITH {_BOOK_CTE}
SELECT 'Cheapest' AS view, url, row_number() OVER (ORDER BY current_price_num, url) AS place
FROM clean WHERE current_price_num IS NOT NULL
UNION ALL SELECT 'Top Rated', url, row_number() OVER (ORDER BY ratings_count DESC, url) FROM clean
WHERE ratings_count IS NOT NULL""")
def q_sink_views(spark, sf):
    """Two sorted views written by one call; their stored order read back as a place."""
    from gleanspark.sources.sinks import write_views
    clean = sites.books_clean(sites.books_raw(render.book_pages(table(spark, sf, "part"))))
    suite = views.book_views(clean, clean)
    paths = write_views({k: suite[k] for k in ("Cheapest", "Top Rated")}, _folder(spark, "views"), base=clean)
    out = [views.ranked(spark.read.parquet(p), [("view_order", "asc")], key=None, rank_col="place")
           .select(F.lit(k).alias("view"), "url", "place") for k, p in paths.items()]
    return out[0].unionByName(out[1])


@register("sink_skips_empty", """
SELECT p_partkey, p_name, false AS written, 0 AS stale FROM part""")
def q_sink_skips_empty(spark, sf):
    """J05 + D17 + A08: writing no rows over a stored table leaves nothing behind, and reading
    what is not there gives an empty table, so every part is still to do."""
    from gleanspark.sources.frontier import remaining
    from gleanspark.sources.sinks import write_table
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    path = _folder(spark, "empty")
    write_table(part, path)
    written = write_table(part.filter("p_partkey < 0"), path)
    stored = read_if_exists(spark, path, part.schema)
    todo = remaining(part, stored, "p_partkey")
    stale = stored.agg(F.count(F.lit(1)).cast("int").alias("stale"))
    return todo.withColumn("written", F.lit(written)).withColumn("one", F.lit(1)) \
        .join(stale.withColumn("one", F.lit(1)), "one").drop("one")


# ---------------------------------------------------------------------------
# Guards, coercion, caps, column order

@register("coerce_number", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice END AS price FROM part""")
def q_coerce_number(spark, sf):
    """C11: numbers from texts; what is no number (a suffix, NaN, words) is NULL."""
    from gleanspark.functions.numbers import coerce_double
    text = F.when(F.col("p_size") % 3 != 0, F.format_string("%.2f", "p_retailprice")) \
        .when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit("d"))).otherwise(F.lit("NaN"))
    return table(spark, sf, "part").select("p_partkey", coerce_double(text).alias("price"))


@register("null_normalisation", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN p_brand END AS brand,
  CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS price FROM part""")
def q_null_normalisation(spark, sf):
    """NaN and the texts of missing values become NULL."""
    from gleanspark.functions.numbers import null_if_missing
    brand = F.element_at(F.array(F.col("p_brand"), F.lit("nan"), F.lit("  "), F.lit("None")),
                         (F.col("p_size") % 4 + 1).cast("int"))
    price = F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice")).otherwise(F.lit(float("nan")))
    return table(spark, sf, "part").select("p_partkey", null_if_missing(brand).alias("brand"),
                                           null_if_missing(price).alias("price"))


@register("type_guards", """
SELECT p_partkey, p_size % 3 = 0 AS has_text,
  CASE p_size % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN '' ELSE '  ' END AS lowered FROM part""")
def q_type_guards(spark, sf):
    """The non-blank test and the lower case that never is NULL."""
    from gleanspark.functions.text import is_nonempty, safe_lower
    text = F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).when(F.col("p_size") % 3 == 2, F.lit("  "))
    return table(spark, sf, "part").select("p_partkey", is_nonempty(text).alias("has_text"),
                                           safe_lower(text).alias("lowered"))


@register("column_order", "SELECT p_brand, p_partkey, p_name FROM part")
def q_column_order(spark, sf):
    """C31 + C33: key columns last, columns dropped whether they are there or not."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    out = views.columns_last(part.drop("p_size", "no_such_column"), ("p_partkey", "p_name"))
    if out.columns != ["p_brand", "p_partkey", "p_name"]:
        raise AssertionError(out.columns)
    return out


@register("preview", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 10")
def q_preview(spark, sf):
    """The first ten rows by name (the limit is the feature)."""
    return views.preview(table(spark, sf, "part").select("p_partkey", "p_name"), [("p_name", "asc")], 10, "p_partkey")


@register("search_frontier_capped", """
WITH q AS (SELECT lower(p_type) || ' items' AS query, least(CAST(ceil(count(*) / 40.0) AS INTEGER), 2) AS n_pages
           FROM part GROUP BY p_type)
SELECT query, CAST(page AS INTEGER) AS page,
  'https://shop.example/catalog/?q=' || replace(query, ' ', '%20') || '&page=' || CAST(page AS VARCHAR) AS url
FROM q, LATERAL (SELECT unnest(generate_series(1, n_pages)) AS page) s""")
def q_search_frontier_capped(spark, sf):
    """A10: at most two pages of each query (the cap is the feature)."""
    from gleanspark.sources.frontier import search_frontier
    q = table(spark, sf, "part").groupBy(F.concat(F.lower("p_type"), F.lit(" items")).alias("query")) \
        .agg(F.ceil(F.count(F.lit(1)) / 40.0).cast("int").alias("n_pages"))
    return search_frontier(q, "https://shop.example/catalog/?q={q}&page={page}", max_pages=2)


@register("places_first_page", """
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS id, c_nationkey AS query_idx FROM customer WHERE c_custkey < 1000
UNION ALL SELECT 'P' || CAST(c_custkey AS VARCHAR), n_regionkey + 100 FROM customer
JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey < 1000""")
def q_places_first_page(spark, sf):
    """A06 + A10: places of the first response page of each query."""
    from gleanspark.sources.places import search_places
    cust, nat, reg, orde = (table(spark, sf, t) for t in ("customer", "nation", "region", "orders"))
    got = search_places(render.place_search_table(cust, nat, reg, orde), max_pages=1)
    return got.select(F.col("p.id").alias("id"), "query_idx")


# ---------------------------------------------------------------------------
# Blocked pages and page-wide lists

@register("blocked_rejects", """
SELECT page_id, url, 'marker' AS reason FROM pages WHERE contains(html, 'spam-farm')""")
def q_blocked_rejects(spark, sf):
    """The reject table of blocked pages (``spam-farm`` marks them in this data)."""
    return sites.route_blocked(heavy_table(spark, sf, "pages").select("page_id", "url", "html"), marker="spam-farm")[1]


@register("unblocked_titles", f"""
SELECT t.* FROM ({ORACLE['extract_titles']}) t JOIN pages p ON p.page_id = t.page_id
WHERE NOT contains(p.html, 'spam-farm')""")
def q_unblocked_titles(spark, sf):
    """Only pages that are not blocked are extracted."""
    from gleanspark.operators.extract import extract
    from gleanspark.plans.specs import PAGE_TITLE
    pages, _ = sites.route_blocked(heavy_table(spark, sf, "pages").select("page_id", "url", "html"), marker="spam-farm")
    return extract(pages, PAGE_TITLE, keep=("page_id",))


@register("quote_lists", """
SELECT user_id // 10 AS page, CAST(row_number() OVER (PARTITION BY user_id // 10 ORDER BY user_id) - 1 AS INTEGER) AS pos,
  '  “Events of user ' || CAST(user_id AS VARCHAR) || '”' AS text, 'User ' || CAST(user_id AS VARCHAR) AS author
FROM (SELECT DISTINCT user_id FROM events) u""")
def q_quote_lists(spark, sf):
    """B04 + B06: page-wide texts and authors as read, zipped by position."""
    return sites.quote_lists(render.quote_pages(table(spark, sf, "events")))


# ---------------------------------------------------------------------------
# Elements inside elements of their kind, attributes without quotes

@register("nested_team_rows", """
SELECT s_suppkey // 25 AS page,
  CAST(row_number() OVER (PARTITION BY s_suppkey // 25 ORDER BY s_suppkey) - 1 AS INTEGER) AS pos,
  s_name || ' nation ' || CAST(s_nationkey AS VARCHAR) || 'key ' || CAST(s_suppkey AS VARCHAR) || ' club' AS name,
  s_nationkey + 1990 AS year, s_nationkey + 10 AS wins, s_nationkey AS losses, 0 AS ot_losses, CAST(0.5 AS DOUBLE) AS win_pct,
  s_nationkey * 3 AS gf, s_nationkey * 2 AS ga, s_nationkey AS diff
FROM supplier""")
def q_nested_team_rows(spark, sf):
    """Rows and cells that hold a table of their own, unclosed and unquoted."""
    return sites.team_table(render.nested_team_pages(table(spark, sf, "supplier")))


@register("menu_items", """
WITH s AS (SELECT s_suppkey // 50 AS page, s_suppkey // 10 AS menu, s_suppkey, s_name FROM supplier),
items AS (
  SELECT page, menu, -1 AS k, 'Group ' || CAST(menu AS VARCHAR) || ' ' || string_agg(s_name, ' ' ORDER BY s_suppkey) || ' end' AS text,
         '/s/' || CAST(min(s_suppkey) AS VARCHAR) || '?a=1&b=2' AS href, count(*) AS links FROM s GROUP BY page, menu
  UNION ALL SELECT page, menu, s_suppkey, s_name, '/s/' || CAST(s_suppkey AS VARCHAR) || '?a=1&b=2', 1 FROM s)
SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY menu, k) - 1 AS INTEGER) AS pos, text, href, links
FROM items""")
def q_menu_items(spark, sf):
    """Every item of a menu of menus, outer items with all they hold, first link and
    number of links."""
    from gleanspark.operators.extract import ExtractSpec, Field, extract
    spec = ExtractSpec("menu", card="nav li.item", fields=(
        Field("text", None), Field("href", "a", attr="href"), Field("links", 'a[href*="?a=1&b"]', attr="href", many=True)))
    got = extract(render.menu_pages(table(spark, sf, "supplier")), spec, keep=("page",))
    return got.withColumn("links", F.size("links").cast("long"))


# ---------------------------------------------------------------------------
# Rejects, suites in one pass, measured skew, buckets, the run log, streams

def _soiled_teams(spark, sf):
    """Team pages on which every seventh supplier's wins are no number."""
    pages = render.team_pages(table(spark, sf, "supplier"))
    marked = F.regexp_replace("html", r'(Supplier#\d*[07]\b(?:(?!<td class="wins">)[\s\S])*<td class="wins">)\s*', "$1x")
    return pages.withColumn("html", marked)


@register("team_rejects", f"""
SELECT CAST(page AS VARCHAR) AS page, pos, 'wins: not a number' AS reason
FROM ({_TEAM_SQL}) t WHERE regexp_matches(name, '[07]$')""")
def q_team_rejects(spark, sf):
    """C10 without a stop: the rows whose wins are no number, with the reason."""
    from gleanspark.operators.rejects import split
    return split(sites.team_checked(_soiled_teams(spark, sf)))[1]


@register("team_accepted", f"SELECT * FROM ({_TEAM_SQL}) t WHERE NOT regexp_matches(name, '[07]$')")
def q_team_accepted(spark, sf):
    """The good rows of the same pages."""
    from gleanspark.operators.rejects import split
    return split(sites.team_checked(_soiled_teams(spark, sf)))[0]


@register("list_rejects", """
WITH p AS (SELECT user_id // 10 AS page, count(DISTINCT user_id) AS n FROM events GROUP BY 1)
SELECT CAST(page AS VARCHAR) AS page, CAST(NULL AS INTEGER) AS pos,
  'lists differ in length: text ' || CAST(n AS VARCHAR) || ', author ' || CAST(n - 1 AS VARCHAR) AS reason
FROM p WHERE page % 3 = 0""")
def q_list_rejects(spark, sf):
    """B06 without a stop: pages whose lists differ in length (one author is missing on every
    third page)."""
    from gleanspark.operators.extract import extract_lists_checked
    from gleanspark.operators.rejects import split
    from gleanspark.plans.specs import QUOTE_LISTS
    pages = render.quote_pages(table(spark, sf, "events")).withColumn("html", F.when(
        F.col("page") % 3 == 0, F.expr("concat(substring_index(html, 'class=\"author\"', 1), 'class=\"lost\"', "
                                       "substring(html, length(substring_index(html, 'class=\"author\"', 1)) + 15))"))
        .otherwise(F.col("html")))
    return split(extract_lists_checked(pages, QUOTE_LISTS, keep=("page",)))[1]


@register("suite_in_one_pass", f"""
WITH {_BOOK_CTE}, priced AS (SELECT * FROM clean WHERE current_price_num IS NOT NULL),
v AS (SELECT 'cheapest' AS view, * FROM priced
      UNION ALL SELECT 'most_expensive', * FROM priced
      UNION ALL SELECT 'top_rated', * FROM clean WHERE ratings_count IS NOT NULL
      UNION ALL SELECT 'under_200', * FROM priced WHERE current_price_num < 200
      UNION ALL SELECT 'above_500', * FROM priced WHERE current_price_num > 500)
SELECT *, row_number() OVER (PARTITION BY view ORDER BY
    CASE WHEN view = 'most_expensive' THEN -current_price_num WHEN view = 'top_rated' THEN -ratings_count
         ELSE current_price_num END NULLS LAST, url) AS place
FROM v""")
def q_suite_in_one_pass(spark, sf):
    """Views of the bookstore suite written by one job and read back; ``place`` is the
    place of each row in its view, by the order column the writer left."""
    from pyspark.sql import Window

    from gleanspark.sources.sinks import write_suite
    # written once: every view and every sample of a sort would read the pages again
    raw = _stored(spark, "raw", sites.books_raw(render.book_pages(table(spark, sf, "part"))))
    clean = _stored(spark, "clean", sites.books_clean(raw))
    paths = write_suite(views.book_views(raw, clean), _folder(spark, "suite"))
    root = paths["Cheapest"].rsplit("/", 1)[0]
    got = spark.read.parquet(root).filter(F.col("view").isin(
        "cheapest", "most_expensive", "top_rated", "under_200", "above_500"))
    # a look at the order for the compare only: one window per view
    return got.withColumn("place", F.row_number().over(
        Window.partitionBy("view").orderBy("view_order")).cast("long")).drop("view_order")


@register("shared_keys", """
SELECT e.event_id, e.event_type, t.n, t.first_ts FROM events e
LEFT JOIN (SELECT event_type, count(*) AS n, min(ts) AS first_ts FROM events WHERE event_type < 'p' GROUP BY 1) t
  ON t.event_type = e.event_type""")
def q_shared_keys(spark, sf):
    """A join on a key of few values; those that hold many rows are measured and dealt over
    shares (a share is a hundredth of the table)."""
    from gleanspark.operators.skew import salted_join
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    types = e.filter("event_type < 'p'").groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))
    share = max(1, e.count() // 100)
    return salted_join(e.drop("ts"), types, "event_type", spread="event_id", rows_per_share=share)


def recent_deliveries(spark, sf, n_drops: int = 3, delay_days: int = 2):
    """(rows, state of every batch) of a stream of events in drops by time, in which every
    event comes once more one drop later, and those whose id 50 divides come in a last drop only."""
    from gleanspark.streaming.recent import load_recent
    root = _folder(spark, "recent")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()         # one row
    at = ((F.unix_micros("ts") - F.unix_micros(F.lit(lo))) * n_drops
          / (F.unix_micros(F.lit(hi)) - F.unix_micros(F.lit(lo)) + 1)).cast("int")
    last = F.col("event_id") % 50 == 0
    sent = e.withColumn("drop", F.explode(F.when(last, F.array(F.lit(n_drops))).otherwise(F.array(at, at + 1))))
    state = []
    for i in range(n_drops + 1):
        sent.filter(F.col("drop") == i).drop("drop").write.mode("append").parquet(f"{root}/source")
        state += load_recent(spark, f"{root}/source", e.schema, f"{root}/sink", f"{root}/checkpoint",
                             ["event_id"], "ts", f"{delay_days} days")
    return spark.read.schema(e.schema).parquet(f"{root}/sink"), state


@register("stream_recent", """
WITH w AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM events WHERE event_id % 50 <> 0)
SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us FROM events, w
WHERE event_id % 50 <> 0 OR date_trunc('millisecond', ts) > date_trunc('millisecond', mark)""")
def q_stream_recent(spark, sf):
    """Streaming keep-first with a watermark. Events delivered again are dropped, first
    deliveries behind the watermark are late."""
    return recent_deliveries(spark, sf)[0].select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("ts_us"))


@register("stream_run_log", f"""
WITH l AS ({ORACLE['listing_extract']}), u AS ({ORACLE['dedup_first']}),
b AS (SELECT min(p_partkey) // 40 AS lo, (max(p_partkey) // 40 - min(p_partkey) // 40) // 3 + 1 AS step FROM part)
SELECT (SELECT count(DISTINCT p_partkey // 40) FROM part) AS pages_read, (SELECT count(*) FROM u) AS kept,
  CAST(0 AS BIGINT) AS rejected, (SELECT count(DISTINCT (page - lo) // step) FROM l, b) AS batches""")
def q_stream_run_log(spark, sf):
    """The run log of a load in drops, summed: pages read, rows kept and rejected, batches."""
    from gleanspark.streaming.incremental import read_log
    from querybook.catalog import listing_drops
    return read_log(spark, listing_drops(spark, sf)).agg(
        F.sum("pages_read").alias("pages_read"), F.sum("kept").alias("kept"), F.sum("rejected").alias("rejected"),
        F.count("*").alias("batches"))


@register("resume_bucketed", """
SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-16'
UNION ALL SELECT event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_id % 2 = 0""")
def q_resume_bucketed(spark, sf):
    """A re-captured batch anti-joined with a stored table in buckets of its key,
    and the stored rows that a second table names."""
    from gleanspark.sources.bucketed import open_bucketed, write_bucketed
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    stored = e.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).select("event_id", "value")
    name, path = f"stored_{uuid.uuid4().hex}", _folder(spark, "stored")
    write_bucketed(stored, name, path, "event_id", 8)
    kept = open_bucketed(spark, name, path, stored.schema, "event_id", 8)
    new = e.filter(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz")).select("event_id", "value")
    fresh = new.join(kept, "event_id", "left_anti")
    out = fresh.unionByName(kept.join(e.filter("event_id % 2 = 0").select("event_id"), "event_id", "left_semi"))
    spark.sql(f"DROP TABLE {name}")                          # external: its files stay
    return out
