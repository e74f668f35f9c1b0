"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
tables. Column names match the oracle SQL one for one. Computed doubles are rounded
in both, so the compare does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.operators import views
from gleanspark.plans import products
from gleanspark.sources.tables import heavy_table, table
from querybook import render

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# Product listing: extraction round trip, keep-first, top-k

_SLUG = "regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g')"


@register("listing_extract", f"""
SELECT page, pos, name, price, price_num, url FROM (
  SELECT p_partkey // 40 AS page,
         CAST(row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) - 1 AS INTEGER) AS pos,
         p_name AS name, '৳ ' || printf('%.2f', p_retailprice) AS price,
         p_retailprice AS price_num,
         'https://shop.example/p/' || {_SLUG} || '-i' || CAST(p_partkey AS VARCHAR) || '.html' AS url,
         p_size
  FROM part) t
WHERE p_size <= 45
""")
def q_listing_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Cards of rendered listing pages -> rows."""
    pages = render.listing_pages(table(spark, sf, "part"))
    return products.listing(pages)


@register("dedup_first", f"""
SELECT page, pos, name, price, price_num, url FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page, pos) AS rn FROM (
    SELECT p_partkey // 40 AS page,
           CAST(row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) - 1 AS INTEGER) AS pos,
           p_name AS name, '৳ ' || printf('%.2f', p_retailprice) AS price,
           p_retailprice AS price_num,
           'https://shop.example/p/' || {_SLUG} || '.html' AS url, p_size
    FROM part) a
  WHERE p_size <= 45) b
WHERE rn = 1
""")
def q_dedup_first(spark, sf):
    """F01 + F03: URLs depend on the name only; validate, then keep the first card
    (page, pos) per normalized URL."""
    pages = render.listing_pages(table(spark, sf, "part"), url_by_name=True)
    return products.listing(pages)


@register("dedup_seen_before_filter", f"""
SELECT page, pos, name, price, price_num, url FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page, pos) AS rn FROM (
    SELECT p_partkey // 40 AS page,
           CAST(row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) - 1 AS INTEGER) AS pos,
           p_name AS name,
           CASE WHEN p_size <= 45 THEN '৳ ' || printf('%.2f', p_retailprice) END AS price,
           CASE WHEN p_size <= 45 THEN p_retailprice END AS price_num,
           'https://shop.example/p/' || {_SLUG} || '.html' AS url
    FROM part) a) b
WHERE rn = 1 AND price IS NOT NULL
""")
def q_dedup_seen_before_filter(spark, sf):
    """the URL is marked seen before validation, so an invalid first card hides
    later valid ones with the same URL."""
    pages = render.listing_pages(table(spark, sf, "part"), url_by_name=True)
    return products.listing(pages, dedup_before_filter=True)


@register("top_cheapest", f"""
SELECT name, price, price_num, url FROM (
  SELECT p_name AS name, '৳ ' || printf('%.2f', p_retailprice) AS price, p_retailprice AS price_num,
         'https://shop.example/p/' || {_SLUG} || '-i' || CAST(p_partkey AS VARCHAR) || '.html' AS url
  FROM part WHERE p_size <= 45) t
ORDER BY price_num, url LIMIT 50
""")
def q_top_cheapest(spark, sf):
    """H01 + H04: search clean table, cheapest 50 (the limit is the feature)."""
    pages = render.listing_pages(table(spark, sf, "part"))
    clean = products.search_clean(products.listing(pages))
    return clean.orderBy(F.col("price_num").asc(), F.col("url").asc()).limit(50)


# ---------------------------------------------------------------------------
# Listing x detail: enrichment, value score, value views

_LISTING_CTE = f"""
lst AS (
  SELECT p_partkey, p_partkey // 40 AS page, p_name AS name,
         '৳ ' || printf('%.2f', p_retailprice) AS price, p_retailprice AS price_num,
         'https://shop.example/p/' || {_SLUG} || '-i' || CAST(p_partkey AS VARCHAR) || '.html' AS url,
         p_type, p_brand, p_size
  FROM part WHERE p_size <= 45),
li AS (
  SELECT l_partkey, count(*) AS n, floor(avg(l_quantity)) / 10.0 AS rating,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS answered,
         min(l_suppkey) AS supp
  FROM lineitem GROUP BY l_partkey),
det AS (
  SELECT lst.*, s_name,
    CASE WHEN p_type NOT IN ('MEDIUM', 'PROMO') THEN li.rating END AS rating_score,
    CASE WHEN p_type NOT IN ('MEDIUM', 'PROMO') THEN li.n END AS rating_count,
    CASE WHEN p_type IN ('STANDARD', 'LARGE', 'ECONOMY') THEN li.answered END AS answered_questions,
    CASE WHEN p_type NOT IN ('MEDIUM', 'PROMO') THEN p_brand END AS brand,
    CASE WHEN p_type NOT IN ('MEDIUM', 'PROMO') THEN s_name END AS seller,
    CASE WHEN p_type NOT IN ('MEDIUM', 'PROMO')
         THEN p_type || ' ' || name || ' & more size ' || CAST(p_size AS VARCHAR) END AS description
  FROM lst LEFT JOIN li ON li.l_partkey = lst.p_partkey
  LEFT JOIN supplier ON s_suppkey = li.supp),
fin AS (
  SELECT page, name, price, price_num,
    round(CASE WHEN price_num > 0 AND rating_score IS NOT NULL
               THEN rating_score * (1 + coalesce(rating_count, 0) / 100.0) / price_num END, 6) AS value_score,
    rating_score, rating_count, answered_questions, brand, seller, description, url
  FROM det)"""


def _final(spark, sf):
    part, li, supp = (table(spark, sf, t) for t in ("part", "lineitem", "supplier"))
    lst = products.listing(render.listing_pages(part))
    det = products.detail_table(render.detail_pages(part, li, supp))
    return products.final_products(lst, det)


@register("listing_detail", f"WITH {_LISTING_CTE} SELECT * FROM fin")
def q_listing_detail(spark, sf):
    """Listing left-joined with extracted details;
    failed and missing detail pages give NULL detail columns."""
    return views.value_views(_final(spark, sf))["Combined"]


@register("value_views_cheapest", f"WITH {_LISTING_CTE} SELECT * FROM fin WHERE price_num IS NOT NULL")
def q_value_cheapest(spark, sf):
    """J07 Cheapest, H01."""
    return views.value_views(_final(spark, sf))["Cheapest"]


@register("value_views_top_rated", f"WITH {_LISTING_CTE} SELECT * FROM fin WHERE rating_score IS NOT NULL")
def q_value_top_rated(spark, sf):
    """J07 Top Rated, H03 (two keys descending, NULLs last)."""
    return views.value_views(_final(spark, sf))["Top Rated"]


@register("value_views_best_value", f"WITH {_LISTING_CTE} SELECT * FROM fin WHERE value_score IS NOT NULL")
def q_value_best(spark, sf):
    """J07 Best Value, H02; the flagship query."""
    return views.value_views(_final(spark, sf))["Best Value"]


@register("value_top10_rated", f"""WITH {_LISTING_CTE}
SELECT * FROM fin WHERE rating_score IS NOT NULL
ORDER BY rating_score DESC NULLS LAST, rating_count DESC NULLS LAST, url LIMIT 10""")
def q_value_top10(spark, sf):
    """H03 + H04 on the value table: best rated ten, count as second key."""
    f = _final(spark, sf).na.drop(subset=["rating_score"])
    return views.top_k(f, [("rating_score", "desc"), ("rating_count", "desc")], 10)


# ---------------------------------------------------------------------------
# Text, URL and page-level reads over documents and pages

# DuckDB (RE2) spellings of the Java (?U) classes used by the Spark side.
_WS = r"[\t\n\x{0b}\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _sql_clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}', ' ', 'g'))"


# The character references that occur in the test pages, decoded by the
# oracle side (``&amp;`` last so it never decodes twice).
_SQL_ENTITIES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"),
                 ("&gt;", ">"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


def _sql_unescape(x: str) -> str:
    for ent, ch in _SQL_ENTITIES:
        x = f"replace({x}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return x


def _sql_text(x: str) -> str:
    """html_text(x, 'clean') in SQL."""
    return _sql_clean(_sql_unescape(f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"))


def _sql_noise(x: str) -> str:
    return (f"regexp_replace({x}, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>',"
            " '', 'g')")


@register("clean_text", f"""
SELECT doc_id, {_sql_clean('text')} AS text_clean FROM documents""")
def q_clean_text(spark, sf):
    """C01 over every document (Unicode whitespace collapsed, ends stripped)."""
    from gleanspark.functions.text import clean_text
    return heavy_table(spark, sf, "documents").select("doc_id", clean_text("text").alias("text_clean"))


@register("clean_all_text_columns", f"""
SELECT conv_id, turn, {_sql_clean('role')} AS role, {_sql_clean('text')} AS text FROM conversations""")
def q_clean_all_text_columns(spark, sf):
    """Clean every string column of a table in one projection."""
    from gleanspark.functions.text import clean_all_text_columns
    return clean_all_text_columns(table(spark, sf, "conversations"))


@register("normalize_url", r"""
SELECT page_id,
  lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' ||
    regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''),
                   '[?#].*$', ''), ';[^/]*$', '') AS url_norm,
  CASE WHEN regexp_matches(url, '^https?://')
       THEN replace(regexp_extract(url, '^https?://([^/?#]*)', 1), 'www.', '') END AS domain,
  CASE WHEN url IS NULL OR url = '' THEN 'No Website'
       WHEN contains(lower(url), 'facebook.com') THEN 'Facebook'
       WHEN contains(lower(url), 'instagram.com') THEN 'Instagram'
       ELSE 'Official Website' END AS site_class
FROM pages""")
def q_normalize_url(spark, sf):
    """C02, C17, C18, D15 over every captured page URL."""
    from gleanspark.functions import get_domain, normalize_url, website_type
    p = heavy_table(spark, sf, "pages")
    return p.select("page_id", normalize_url("url", F.col("url")).alias("url_norm"),
                    get_domain("url").alias("domain"), website_type("url").alias("site_class"))


@register("email_docs", f"""
SELECT doc_id, email FROM (
  SELECT doc_id, regexp_extract(text, '[\\p{{L}}\\p{{N}}_.-]+@[\\p{{L}}\\p{{N}}_.-]+', 0) AS email
  FROM documents) t WHERE email <> ''""")
def q_email_docs(spark, sf):
    """C23 over every document; documents without an address give no row."""
    from gleanspark.functions.text import extract_email
    d = heavy_table(spark, sf, "documents")
    return d.select("doc_id", extract_email("text").alias("email")).filter(F.col("email").isNotNull())


@register("email_pages", f"""
SELECT page_id, email FROM (
  SELECT page_id, regexp_extract(html, '[\\p{{L}}\\p{{N}}_.-]+@[\\p{{L}}\\p{{N}}_.-]+', 0) AS email
  FROM pages) t WHERE email <> ''""")
def q_email_pages(spark, sf):
    """C23 over captured pages (E06 reads the same column after the URL join)."""
    from gleanspark.functions.text import extract_email
    p = heavy_table(spark, sf, "pages")
    return p.select("page_id", extract_email("html").alias("email")).filter(F.col("email").isNotNull())


@register("extract_titles", f"""
SELECT page_id, title FROM (
  SELECT page_id, nullif({_sql_text("regexp_extract(" + _sql_noise("html") + ", '(?is)<title\\b[^>]*>(.*?)(</title\\s*>|$)', 1)")}, '') AS title
  FROM pages) t""")
def q_extract_titles(spark, sf):
    """One record per page, the cleaned title text."""
    from gleanspark.operators.extract import extract
    from gleanspark.plans.specs import PAGE_TITLE
    return extract(heavy_table(spark, sf, "pages"), PAGE_TITLE, keep=("page_id",))


@register("extract_nav_links", f"""
WITH nav AS (
  SELECT page_id, regexp_extract({_sql_noise("html")}, '(?is)<nav\\b[^>]*>(.*?)(</nav\\s*>|$)', 1) AS nav FROM pages),
lis AS (
  SELECT page_id, unnest(string_split_regex(nav, '<li\\b[^>]*>')) AS li,
         unnest(range(len(string_split_regex(nav, '<li\\b[^>]*>')))) AS i
  FROM nav)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
  nullif(regexp_extract(li, '<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1), '') AS href,
  nullif({_sql_text("regexp_extract(regexp_replace(li, '(?s)</li\\s*>.*$', ''), '(?is)<a\\b[^>]*>(.*?)(</a\\s*>|$)', 1)")}, '') AS text,
  CASE WHEN regexp_extract(li, '<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1) LIKE '/%'
       THEN regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)
            || regexp_replace(regexp_extract(li, '<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1), '[?#].*$', '') END AS link
FROM lis JOIN (SELECT page_id AS pid, url AS u FROM pages) p ON p.pid = lis.page_id
WHERE i > 0""")
def q_extract_nav_links(spark, sf):
    """One row per ``nav li`` with its link resolved against the
    page URL."""
    from gleanspark.functions.urls import normalize_url
    from gleanspark.operators.extract import extract
    from gleanspark.plans.specs import NAV_LINKS
    p = heavy_table(spark, sf, "pages")
    links = extract(p.select("page_id", "url", "html"), NAV_LINKS, keep=("page_id", "url"))
    return links.select("page_id", "pos", "href", "text",
                        normalize_url("href", F.col("url")).alias("link"))


@register("extract_paragraphs", f"""
WITH art AS (
  SELECT page_id, regexp_extract({_sql_noise("html")}, '(?is)<article\\b[^>]*>(.*?)(</article\\s*>|$)', 1) AS a FROM pages),
ps AS (
  SELECT page_id, unnest(string_split_regex(a, '(?i)<p\\b[^>]*>')) AS piece,
         unnest(range(len(string_split_regex(a, '(?i)<p\\b[^>]*>')))) AS i
  FROM art),
txt AS (
  SELECT page_id, i, {_sql_text("regexp_replace(piece, '(?is)(</p\\s*>|<(div|h[1-6]|ul|ol|table|article|section|footer|nav|header|aside|form|pre|blockquote)\\b|</(div|article|section|body|td|li|main|aside|footer|header)\\s*>).*$', '')")} AS t
  FROM ps WHERE i > 0)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, t AS text
FROM txt WHERE t <> ''""")
def q_extract_paragraphs(spark, sf):
    """B04 with a descendant selector: every ``article p`` text, an unclosed ``<p>``
    ending where the next block starts."""
    from gleanspark.operators.extract import extract
    from gleanspark.plans.specs import PARAGRAPHS
    x = extract(heavy_table(spark, sf, "pages"), PARAGRAPHS, keep=("page_id",))
    return x.select("page_id", F.posexplode("paras").alias("pos", "text"))


@register("page_flags", """
SELECT page_id,
  coalesce(contains(html, 'Captcha Interception'), false)
    OR coalesce(contains(url, '_____tmd_____/punish'), false)
    OR coalesce(contains(html, 'spam-farm'), false) AS is_blocked,
  coalesce(contains(html, 'Logout'), false) AS logged_in,
  coalesce(contains(lower(html), '</body>'), false) AS complete
FROM pages""")
def q_page_flags(spark, sf):
    """Blocked-page and page-state flags for every captured page (a marker
    list is a parameter; ``spam-farm`` marks link-farm pages in this data)."""
    from gleanspark.functions.classify import is_blocked, is_logged_in
    p = heavy_table(spark, sf, "pages")
    return p.select("page_id",
                    (is_blocked("html", "url") | F.coalesce(F.col("html").contains("spam-farm"),
                                                            F.lit(False))).alias("is_blocked"),
                    is_logged_in("html").alias("logged_in"),
                    F.coalesce(F.lower("html").contains("</body>"), F.lit(False)).alias("complete"))


# ---------------------------------------------------------------------------
# Captured sites: catalogue, parallel lists, team tables, quotes, directory

@register("catalogue", """
SELECT p_partkey // 20 AS page,
       CAST(row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS INTEGER) AS pos,
       p_name AS title, '£' || printf('%.2f', p_retailprice) AS price, p_size % 5 + 1 AS rating
FROM part""")
def q_catalogue(spark, sf):
    """B09 (class token), C13 (strict word map), B03 (title attribute)."""
    from gleanspark.plans import sites
    return sites.catalogue(render.catalogue_pages(table(spark, sf, "part")))


@register("countries_zip", """
SELECT n_name || '-' || CAST(c_custkey // 50 AS VARCHAR) AS page,
       CAST(row_number() OVER (PARTITION BY n_name, c_custkey // 50 ORDER BY c_custkey) - 1 AS INTEGER) AS pos,
       c_name AS name, ' Capital of ' || n_name AS capital,
       CAST(c_custkey * 1000 + 5 AS DOUBLE) AS population, c_acctbal AS area
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_countries_zip(spark, sf):
    """B06 positional zip of page-wide lists, C10 strict double casts, C12 character
    removal; pages rendered from customer x nation."""
    from gleanspark.plans import sites
    return sites.countries(render.country_pages(table(spark, sf, "customer"), table(spark, sf, "nation")))


_TEAM_SQL = """
SELECT s_suppkey // 25 AS page,
       CAST(row_number() OVER (PARTITION BY s_suppkey // 25 ORDER BY s_suppkey) - 1 AS INTEGER) AS pos,
       s_name AS name, s_nationkey + 1990 AS year, s_nationkey + 10 AS wins, s_nationkey AS losses,
       CASE WHEN s_acctbal < 0 THEN 0 ELSE s_nationkey END AS ot_losses,
       CASE WHEN s_acctbal < 0 THEN 0.0 ELSE s_acctbal / 10000.0 END AS win_pct,
       s_nationkey * 3 AS gf, s_nationkey * 2 AS ga, s_nationkey AS diff
FROM supplier"""


@register("team_rows", _TEAM_SQL)
def q_team_rows(spark, sf):
    """B07 table rows, C09 empty -> 0, C10 strict casts."""
    from gleanspark.plans import sites
    return sites.team_table(render.team_pages(table(spark, sf, "supplier")))


@register("team_search", f"""
SELECT * FROM ({_TEAM_SQL}) t WHERE contains(lower(name), '#00000007')""")
def q_team_search(spark, sf):
    """D11 team-name search over unfiltered pages; the name stands on a late page."""
    from gleanspark.plans import sites
    return sites.team_search(render.team_pages(table(spark, sf, "supplier")), "#00000007")


@register("team_search_results", f"""
WITH t AS ({_TEAM_SQL}),
r AS (SELECT 'nation ' || CAST(losses AS VARCHAR) AS query, t.* FROM t),
hit AS (SELECT * FROM r WHERE ot_losses > 0 OR losses = 0),
pg AS (SELECT DISTINCT query, page FROM r),
fe AS (SELECT pg.query, min(pg.page) AS first_empty FROM pg
       LEFT JOIN (SELECT DISTINCT query, page FROM hit) h ON h.query = pg.query AND h.page = pg.page
       WHERE h.page IS NULL GROUP BY pg.query)
SELECT hit.* FROM hit LEFT JOIN fe ON fe.query = hit.query
WHERE fe.first_empty IS NULL OR hit.page < fe.first_empty""")
def q_team_search_results(spark, sf):
    """Each nation is a search over the team pages; pages where the search had no
    result are empty result pages, and reading stops at the first."""
    from gleanspark.plans import sites
    teams = sites.team_table(render.team_pages(table(spark, sf, "supplier")))
    rows = teams.select(F.concat(F.lit("nation "), F.col("losses").cast("string")).alias("query"), "*")
    hits = rows.filter((F.col("ot_losses") > 0) | (F.col("losses") == 0))
    return sites.stop_at_first_empty(hits, rows)


@register("quotes_tags", """
SELECT user_id // 10 AS page,
       CAST(row_number() OVER (PARTITION BY user_id // 10 ORDER BY user_id) - 1 AS INTEGER) AS pos,
       '“Events of user ' || CAST(user_id AS VARCHAR) || '”' AS text,
       'User ' || CAST(user_id AS VARCHAR) AS author, tags
FROM (SELECT user_id, string_agg(event_type, ', ' ORDER BY event_type) AS tags
      FROM (SELECT DISTINCT user_id, event_type FROM events) d GROUP BY user_id) u""")
def q_quotes_tags(spark, sf):
    """B04 all-match texts, B10 tags joined with ', ', card-first extraction."""
    from gleanspark.plans import sites
    return sites.quotes(render.quote_pages(table(spark, sf, "events")))


@register("directory", """
SELECT DISTINCT c_name AS name,
  'House ' || CAST(c_custkey AS VARCHAR) || ', ' || n_name || ' , ' ||
    CASE n_regionkey WHEN 0 THEN 'Dhaka' WHEN 1 THEN 'Dhaka-1207' WHEN 2 THEN 'DHAKA'
                     WHEN 3 THEN 'Dhaka Road, Sylhet' ELSE 'Chittagong' END AS address,
  CASE WHEN c_acctbal >= 0 THEN '+880 ' || CAST(c_custkey AS VARCHAR) END AS phone,
  CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'Vehicle services' ELSE 'Restaurant' END AS category
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey IN (0, 1, 2) AND NOT (c_mktsegment = 'AUTOMOBILE' AND c_nationkey < 5)""")
def q_directory(spark, sf):
    """B08 icon-guarded phone, D01, D03 home-city filter, A09 category from the page,
    F02 exact 4-column dedup of repeated cards."""
    from gleanspark.plans import sites
    return sites.directory(render.directory_pages(table(spark, sf, "customer"), table(spark, sf, "nation")))


# ---------------------------------------------------------------------------
# Bookstore suite

_BOOK_CTE = """
b AS (
  SELECT p_partkey, p_type, p_size,
    CASE WHEN p_type = 'PROMO' THEN p_name || ' Quran Tafsir'
         WHEN p_type = 'LARGE' THEN p_name || ' হাদিস সংকলন' ELSE p_name END AS title,
    p_brand AS author,
    'TK. ' || CAST((CAST(floor(p_retailprice) AS INTEGER) - 900) * 6 AS VARCHAR) AS current_price,
    CASE WHEN p_type = 'ECONOMY' THEN NULL
         ELSE 'TK. ' || CAST((CAST(floor(p_retailprice) AS INTEGER) - 900) * 6 + p_size * 5 AS VARCHAR) END AS original_price,
    CAST((CAST(floor(p_retailprice) AS INTEGER) - 900) * 6 AS DOUBLE) AS current_price_num,
    CASE WHEN p_size > 10 THEN CAST(p_size - 10 AS BIGINT) END AS ratings_count,
    CASE WHEN p_size > 25 THEN 'In Stock' ELSE 'Out of stock' END AS stock_text,
    'https://books.example/book/' || CAST(p_partkey AS VARCHAR) || '/' || regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') AS url
  FROM part WHERE p_type NOT IN ('SMALL', 'MEDIUM')),
clean AS (SELECT title, author, current_price, original_price, current_price_num, ratings_count, stock_text, url FROM b)"""


def _books(spark, sf):
    from gleanspark.plans import sites
    raw = sites.books_raw(render.book_pages(table(spark, sf, "part")))
    return raw, sites.books_clean(raw)


def _book_view(name):
    def fn(spark, sf):
        raw, clean = _books(spark, sf)
        return views.book_views(raw, clean)[name]
    return fn


register("book_clean", f"WITH {_BOOK_CTE} SELECT * FROM clean")(_book_view("Clean"))
register("book_raw", f"""WITH {_BOOK_CTE}
SELECT title AS raw_title, author AS raw_author, current_price AS raw_current_price,
       original_price AS raw_original_price, ratings_count, stock_text, url FROM clean""")(_book_view("Raw"))
register("book_most_expensive", f"WITH {_BOOK_CTE} SELECT * FROM clean")(_book_view("Most Expensive"))
register("book_top_rated", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE ratings_count IS NOT NULL")(_book_view("Top Rated"))
register("book_under_200", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE current_price_num < 200")(_book_view("Under 200"))
register("book_200_to_500", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE current_price_num BETWEEN 200 AND 500")(_book_view("200 to 500"))
register("book_above_500", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE current_price_num > 500")(_book_view("Above 500"))
register("book_quran", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE regexp_matches(lower(title), 'কুরআন|quran|qur''an')")(_book_view("Quran"))
register("book_hadith", f"WITH {_BOOK_CTE} SELECT * FROM clean WHERE regexp_matches(lower(title), 'হাদিস|hadith')")(_book_view("Hadith"))
register("book_top_cheapest_50", f"WITH {_BOOK_CTE} SELECT * FROM clean ORDER BY current_price_num, url LIMIT 50")(_book_view("Top Cheapest 50"))


@register("book_best", f"""WITH {_BOOK_CTE}
SELECT *, round(ratings_count / current_price_num, 6) AS score FROM clean
WHERE ratings_count >= 5 AND current_price_num > 0""")
def q_book_best(spark, sf):
    """D09 + C38: recommended books, score = ratings per taka."""
    raw, clean = _books(spark, sf)
    v = views.book_views(raw, clean)["Best Books Recommended"]
    return v.withColumn("score", F.round("score", 6))


# ---------------------------------------------------------------------------
# Places: JSON search + detail responses -> enrichment -> classes -> views

_EMAIL_RE = r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+"

_PLACES_CTE = f"""
oc AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
mails AS (
  SELECT site, arg_min(e, page_id) AS email FROM (
    SELECT trim(url) AS site, page_id,
           nullif(regexp_extract(html, '{_EMAIL_RE}', 0), '') AS e FROM pages) m
  WHERE e IS NOT NULL GROUP BY site),
f AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_regionkey, oc.n AS rating_count,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Free' WHEN 'BUILDING' THEN 'Cheap'
         WHEN 'FURNITURE' THEN 'Moderate' WHEN 'MACHINERY' THEN 'Expensive' ELSE 'Very Expensive' END AS price_level,
    CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'MACHINERY' THEN 3
         WHEN 'HOUSEHOLD' THEN 4 END AS lvl,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Grill' WHEN 'MACHINERY' THEN 'Fried Chicken'
         WHEN 'FURNITURE' THEN 'Cafe' WHEN 'BUILDING' THEN 'Fast Food' ELSE 'Burgers' END AS kw,
    CASE WHEN c_acctbal >= 0 THEN (floor(c_acctbal / 1000) + 1) / 2.0 END AS rating,
    CASE n_regionkey WHEN 0 THEN 'Gulshan 2, Dhaka' WHEN 1 THEN 'Dhanmondi, Dhaka'
         WHEN 2 THEN 'Uttara Sector 4, Dhaka' WHEN 3 THEN 'Banani, Dhaka' ELSE 'Agrabad, Chattogram' END AS area_text,
    p.url AS page_url
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN oc ON oc.o_custkey = c.c_custkey
  LEFT JOIN pages p ON p.page_id = c.c_custkey),
g AS (
  SELECT *,
    CASE WHEN c_nationkey = 5 OR c_mktsegment = 'AUTOMOBILE' THEN NULL
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'https://facebook.com/p' || CAST(c_custkey AS VARCHAR)
         WHEN c_mktsegment = 'MACHINERY' THEN 'https://www.instagram.com/p' || CAST(c_custkey AS VARCHAR)
         ELSE page_url END AS website
  FROM f),
raw AS (
  SELECT 'P' || CAST(c_custkey AS VARCHAR) AS id,
    c_name || '  ' || kw AS name,
    'House ' || CAST(c_custkey AS VARCHAR) || ', Road ' || CAST(c_nationkey AS VARCHAR) || ',  ' || area_text AS address,
    CASE WHEN c_nationkey = 5 THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN '+880 1' || CAST(c_custkey AS VARCHAR)
         ELSE '01' || CAST(c_custkey AS VARCHAR) END AS phone,
    rating, rating_count, price_level,
    CASE WHEN lvl IS NOT NULL THEN 'BDT ' || CAST(lvl * 100 AS VARCHAR) || '.50' END AS price_start,
    CASE WHEN lvl IS NOT NULL THEN 'BDT ' || CAST(lvl * 200 AS VARCHAR) || '.50' END AS price_end,
    'https://maps.example/?cid=' || CAST(c_custkey AS VARCHAR) AS maps_link,
    website, lvl
  FROM g),
clean AS (
  SELECT id, {_sql_clean('name')} AS name, {_sql_clean('address')} AS address, phone, rating, rating_count,
    price_level, price_start, price_end, website, maps_link,
    CASE WHEN regexp_matches(website, '^https?://')
         THEN replace(regexp_extract(website, '^https?://([^/?#]*)', 1), 'www.', '') END AS domain,
    CASE WHEN website IS NULL OR website = '' THEN 'No Website'
         WHEN contains(lower(website), 'facebook.com') THEN 'Facebook'
         WHEN contains(lower(website), 'instagram.com') THEN 'Instagram' ELSE 'Official Website' END AS website_type,
    CASE WHEN website IS NOT NULL AND NOT contains(lower(website), 'facebook.com')
              AND NOT contains(lower(website), 'instagram.com') AND regexp_matches(website, '^https?://')
         THEN (SELECT email FROM mails WHERE mails.site = trim(raw.website)) END AS email,
    CASE WHEN contains(lower(name), 'grill') THEN 'Grill Burger'
         WHEN contains(lower(name), 'fried') THEN 'Fried Chicken + Burger'
         WHEN contains(lower(name), 'cafe') THEN 'Cafe Burger'
         WHEN contains(lower(name), 'fast food') THEN 'Fast Food Burger' ELSE 'General Burger' END AS kind,
    CASE WHEN price_level = 'Cheap' THEN 'Budget' WHEN price_level = 'Moderate' THEN 'Mid-range'
         WHEN price_level IN ('Expensive', 'Very Expensive') THEN 'Premium' ELSE 'Unknown' END AS price_category,
    CASE WHEN rating IS NULL THEN 'No Rating' WHEN rating >= 4.5 THEN 'Excellent' WHEN rating >= 4 THEN 'Good'
         WHEN rating >= 3 THEN 'Average' ELSE 'Poor' END AS rating_category,
    round(CASE WHEN rating IS NOT NULL AND lvl > 0 THEN rating / lvl END, 6) AS value_score,
    CASE WHEN contains(lower(address), 'gulshan') THEN 'Gulshan' WHEN contains(lower(address), 'dhanmondi') THEN 'Dhanmondi'
         WHEN contains(lower(address), 'uttara') THEN 'Uttara' ELSE 'Other' END AS area
  FROM raw WHERE contains(lower(address), 'dhaka'))"""


def _places(spark, sf):
    from gleanspark.plans import places
    cust, nat, reg, orde, pgs = (table(spark, sf, t) for t in ("customer", "nation", "region", "orders", "pages"))
    search = render.place_search_table(cust, nat, reg, orde)
    details = render.place_detail_table(cust, nat, orde, pgs)
    return places.places_pipeline(search, details, pgs)


def _place_view(name):
    def fn(spark, sf):
        raw, clean = _places(spark, sf)
        return views.place_views(raw, clean)[name]
    fn.__doc__ = f"J09 view {name!r}."
    return fn


register("places_raw", f"""WITH {_PLACES_CTE}
SELECT id, name, address, phone, rating, rating_count, price_level, price_start, price_end, maps_link, website FROM raw""")(_place_view("Raw"))
register("places_clean", f"WITH {_PLACES_CTE} SELECT * FROM clean")(_place_view("Clean"))
register("place_cheapest", f"""WITH {_PLACES_CTE}
SELECT * FROM clean WHERE price_level IN ('Free', 'Cheap') ORDER BY rating DESC NULLS LAST, id LIMIT 10""")(_place_view("Cheapest"))
register("place_premium", f"""WITH {_PLACES_CTE}
SELECT * FROM clean WHERE price_level IN ('Expensive', 'Very Expensive') ORDER BY rating DESC NULLS LAST, id LIMIT 10""")(_place_view("Premium"))
register("place_top_rated", f"""WITH {_PLACES_CTE}
SELECT * FROM clean ORDER BY rating DESC NULLS LAST, rating_count DESC NULLS LAST, id LIMIT 10""")(_place_view("Top Rated"))
register("place_most_reviewed", f"""WITH {_PLACES_CTE}
SELECT * FROM clean ORDER BY rating_count DESC NULLS LAST, id LIMIT 10""")(_place_view("Most Reviewed"))
register("place_best_valued", f"""WITH {_PLACES_CTE}
SELECT * FROM clean ORDER BY value_score DESC NULLS LAST, id LIMIT 10""")(_place_view("Best Valued"))
register("place_website_stats", f"""WITH {_PLACES_CTE}
SELECT website_type, count(*) AS "Count" FROM clean GROUP BY website_type""")(_place_view("Website Analysis"))
register("place_area_stats", f"""WITH {_PLACES_CTE}
SELECT area, count(*) AS "Count" FROM clean GROUP BY area""")(_place_view("Area Analysis"))


# ---------------------------------------------------------------------------
# Number parsing on rendered texts

@register("price_parse", """
SELECT p_partkey,
  round(p_retailprice * p_size, 2) AS price_strict, round(p_retailprice * p_size, 2) AS price_first,
  CAST(NULL AS DOUBLE) AS range_strict, round(p_retailprice * p_size, 2) AS range_first,
  round(p_retailprice * p_size, 2) AS price_tk
FROM part""")
def q_price_parse(spark, sf):
    """C04 strict, C05 first number, C08 TK marker on prices rendered with thousands
    separators (``৳ 12,345.60``, ``৳ a - ৳ b``, ``TK. 12,345.60``)."""
    from gleanspark.functions.numbers import price_first, price_marker, price_strict
    p = table(spark, sf, "part")
    amt = F.col("p_retailprice") * F.col("p_size")
    txt = F.concat(F.lit("৳ "), F.format_number(amt, 2))
    rng = F.concat(txt, F.lit(" - ৳ "), F.format_number(amt * 2, 2))
    tk = F.concat(F.lit("TK. "), F.format_number(amt, 2))
    return p.select("p_partkey", price_strict(txt).alias("price_strict"), price_first(txt).alias("price_first"),
                    price_strict(rng).alias("range_strict"), price_first(rng).alias("range_first"),
                    price_marker(tk).alias("price_tk"))


@register("int_float_parse", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity * 1000 + l_linenumber AS BIGINT) END AS ratings,
  l_discount AS discount, l_tax AS tax,
  CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_linenumber END AS line_no
FROM lineitem""")
def q_int_float_parse(spark, sf):
    """C06 clean_int (``12,003 Ratings``, ``No Ratings``), C07 clean_float (sign lost),
    C09 empty -> 0."""
    from gleanspark.functions.numbers import clean_float, clean_int, zero_if_empty
    li = table(spark, sf, "lineitem")
    ratings = F.when(F.col("l_returnflag") == "N", F.lit("No Ratings")).otherwise(
        F.concat(F.format_number(F.col("l_quantity") * 1000 + F.col("l_linenumber"), 0), F.lit(" Ratings")))
    disc = F.concat(F.col("l_discount").cast("string"), F.lit("/5"))
    tax = F.concat(F.lit("-"), F.col("l_tax").cast("string"))
    line = F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(
        F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" ")))
    return li.select("l_orderkey", "l_linenumber", clean_int(ratings).alias("ratings"),
                     clean_float(disc).alias("discount"), clean_float(tax).alias("tax"),
                     zero_if_empty(line, "int").alias("line_no"))


@register("money_text", """
SELECT p_partkey,
  CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN printf('%.2f', p_retailprice)
       ELSE 'BDT ' || printf('%.2f', p_retailprice) END AS price_start,
  CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN printf('%.2f', p_retailprice * 2)
       ELSE 'BDT ' || printf('%.2f', p_retailprice * 2) END AS price_end
FROM part""")
def q_money_text(spark, sf):
    """C15 money -> text, C16 price range, from JSON built with ``to_json``: units as
    text, nanos as the fraction; no currency for SMALL; no range for PROMO."""
    from gleanspark.functions.numbers import price_range_text
    from gleanspark.sources.places import PRICE_RANGE
    p = table(spark, sf, "part")

    def money(v):
        units = F.floor(v)
        nanos = F.round((v - units) * 1e9).cast("long")
        cur = F.when(F.col("p_type") != "SMALL", F.lit("BDT"))
        return F.struct(cur.alias("currencyCode"), units.cast("string").alias("units"),
                        nanos.cast("string").alias("nanos"))
    body = F.to_json(F.struct(F.when(F.col("p_type") != "PROMO", F.struct(
        money(F.col("p_retailprice")).alias("startPrice"),
        money(F.col("p_retailprice") * 2).alias("endPrice"))).alias("priceRange")))
    parsed = p.select("p_partkey", F.from_json(body, f"priceRange {PRICE_RANGE.simpleString()}").alias("j"))
    r = price_range_text(F.col("j.priceRange"))
    return parsed.select("p_partkey", r["start"].alias("price_start"), r["end"].alias("price_end"))


# ---------------------------------------------------------------------------
# Frontiers, resume by anti join, first empty page, page chain

@register("search_frontier", """
WITH q AS (SELECT lower(p_type) || ' items' AS query, CAST(ceil(count(*) / 40.0) AS INTEGER) AS n_pages
           FROM part GROUP BY p_type)
SELECT query, CAST(page AS INTEGER) AS page,
  'https://shop.example/catalog/?q=' || replace(query, ' ', '%20') || '&page=' || CAST(page AS VARCHAR) AS url
FROM q, LATERAL (SELECT unnest(generate_series(1, n_pages)) AS page) s""")
def q_search_frontier(spark, sf):
    """A02 number range, A03 query encoding, A05 query x page (a generator, no cross
    join): one search query per part type, as many pages as 40-card pages it fills."""
    from gleanspark.sources.frontier import search_frontier
    q = table(spark, sf, "part").groupBy(F.concat(F.lower("p_type"), F.lit(" items")).alias("query")) \
        .agg(F.ceil(F.count(F.lit(1)) / 40.0).cast("int").alias("n_pages"))
    return search_frontier(q, "https://shop.example/catalog/?q={q}&page={page}")


@register("segmented_frontier", """
WITH s AS (
  SELECT c_mktsegment AS category, CAST(ceil(count(*) / 20.0) AS INTEGER) AS n_pages FROM customer GROUP BY 1),
o AS (SELECT *, coalesce(sum(n_pages) OVER (ORDER BY category ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM s)
SELECT category, CAST(page AS INTEGER) AS page, CAST(off + page AS BIGINT) AS run_index,
  CASE WHEN page = 1 THEN 'https://directory.example/category/' || category || '/city:Dhaka'
       ELSE 'https://directory.example/category/' || category || '/' || CAST(page AS VARCHAR) || '/city:Dhaka' END AS url
FROM o, LATERAL (SELECT unnest(generate_series(1, n_pages)) AS page) g""")
def q_segmented_frontier(spark, sf):
    """Categories as consecutive segments of one running page index; page 1 of a
    category has no page number in its URL."""
    from gleanspark.sources.frontier import segmented_frontier
    seg = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("category")) \
        .agg(F.ceil(F.count(F.lit(1)) / 20.0).cast("int").alias("n_pages"))
    seg = seg.select("category", "n_pages", F.col("category").alias("seg_order"),
                     F.concat(F.lit("https://directory.example/category/"), F.col("category"),
                              F.lit("/city:Dhaka")).alias("first_url"),
                     F.concat(F.lit("https://directory.example/category/"), F.col("category"),
                              F.lit("/{page}/city:Dhaka")).alias("page_url"))
    out = segmented_frontier(seg)
    return out.select("category", "page", F.col("run_index").cast("long").alias("run_index"), "url")


@register("remaining_pages", f"""
WITH kept AS (
  SELECT DISTINCT page FROM (
    SELECT p_partkey // 40 AS page, 'https://shop.example/p/' || {_SLUG} || '.html' AS url,
           row_number() OVER (PARTITION BY {_SLUG} ORDER BY p_partkey) AS rn
    FROM part WHERE p_size <= 45) a WHERE rn = 1),
allp AS (SELECT DISTINCT p_partkey // 40 AS page FROM part)
SELECT page FROM allp WHERE page NOT IN (SELECT page FROM kept)""")
def q_remaining_pages(spark, sf):
    """Listing pages with no stored row yet (stored = the deduplicated listing)."""
    from gleanspark.sources.frontier import remaining
    pages = render.listing_pages(table(spark, sf, "part"), url_by_name=True)
    stored = products.listing(pages)
    return remaining(pages.select("page"), stored, "page")


@register("remaining_urls", f"""WITH {_LISTING_CTE}
SELECT url FROM lst WHERE p_type IN ('MEDIUM', 'PROMO')""")
def q_remaining_urls(spark, sf):
    """E04 with retry of failed pages: URLs whose detail is missing or extracted
    nothing."""
    from gleanspark.sources.frontier import remaining_urls
    part, li, supp = (table(spark, sf, t) for t in ("part", "lineitem", "supplier"))
    lst = products.listing(render.listing_pages(part))
    det = products.detail_table(render.detail_pages(part, li, supp))
    return remaining_urls(lst.select("url"), det, retry_failed=True)


@register("remaining_urls_keep_failed", f"""WITH {_LISTING_CTE}
SELECT url FROM lst WHERE p_type = 'PROMO'""")
def q_remaining_urls_keep_failed(spark, sf):
    """E04 where a failed detail counts as done: only never-captured URLs remain."""
    from gleanspark.sources.frontier import remaining_urls
    part, li, supp = (table(spark, sf, t) for t in ("part", "lineitem", "supplier"))
    lst = products.listing(render.listing_pages(part))
    det = products.detail_table(render.detail_pages(part, li, supp))
    return remaining_urls(lst.select("url"), det, retry_failed=False)


@register("first_empty_page", """
WITH e AS (SELECT event_type AS query, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS page,
                  event_id, value FROM events),
hits AS (SELECT * FROM e WHERE value > 200),
pg AS (SELECT DISTINCT query, page FROM e),
cnt AS (SELECT pg.query, pg.page, count(hits.event_id) AS n FROM pg
        LEFT JOIN hits ON hits.query = pg.query AND hits.page = pg.page GROUP BY pg.query, pg.page),
fe AS (SELECT query, min(page) AS first_empty FROM cnt WHERE n = 0 GROUP BY query)
SELECT hits.query, hits.page, hits.event_id, hits.value FROM hits LEFT JOIN fe ON fe.query = hits.query
WHERE fe.first_empty IS NULL OR hits.page < fe.first_empty""")
def q_first_empty_page(spark, sf):
    """D12 + F06: each event type is a search, each day a result page, events above
    200 are its cards; rows of pages from the first empty page on are not read."""
    from gleanspark.plans.sites import stop_at_first_empty
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("query"),
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("page"),
        "event_id", "value")
    return stop_at_first_empty(e.filter(F.col("value") > 200), e)


@register("page_chain", """
WITH RECURSIVE pg AS (SELECT DISTINCT user_id // 10 AS page FROM events),
e AS (SELECT 'https://quotes.example/page/' || CAST(page AS VARCHAR) || '/' AS url,
             CASE WHEN (page + 1) % 10 <> 0 AND page + 1 IN (SELECT page FROM pg)
                  THEN 'https://quotes.example/page/' || CAST(page + 1 AS VARCHAR) || '/' END AS next_url
      FROM pg),
heads AS (SELECT url FROM e WHERE url NOT IN (SELECT next_url FROM e WHERE next_url IS NOT NULL)),
r(start_url, depth, url) AS (
  SELECT url, CAST(0 AS BIGINT), url FROM heads
  UNION ALL
  SELECT r.start_url, r.depth + 1, e.next_url FROM r JOIN e ON e.url = r.url WHERE e.next_url IS NOT NULL)
SELECT start_url, depth, url FROM r""")
def q_page_chain(spark, sf):
    """B13 next-link extraction, B24 prefixing, B14 chain order by pointer jumping."""
    from gleanspark.functions.urls import prefix_url
    from gleanspark.operators.chain import chain_order
    from gleanspark.operators.extract import extract
    from gleanspark.plans.specs import NEXT_LINK
    pages = render.quote_pages(table(spark, sf, "events"))
    links = extract(pages.select("url", "html"), NEXT_LINK, keep=("url",))
    base = "https://quotes.example"
    edges = links.select(prefix_url("url", base).alias("url"), prefix_url("next_href", base).alias("next_url"))
    return chain_order(edges)


@register("quotes_chain", """
WITH RECURSIVE pg AS (SELECT DISTINCT user_id // 10 AS page FROM events),
nx AS (SELECT page, CASE WHEN (page + 1) % 10 <> 0 AND page + 1 IN (SELECT page FROM pg) THEN page + 1 END AS nxt FROM pg),
r(start, depth, page) AS (
  SELECT page, CAST(0 AS BIGINT), page FROM pg WHERE page % 5 = 0
  UNION ALL
  SELECT r.start, r.depth + 1, nx.nxt FROM r JOIN nx ON nx.page = r.page WHERE nx.nxt IS NOT NULL),
u AS (SELECT user_id, user_id // 10 AS page, string_agg(event_type, ', ' ORDER BY event_type) AS tags
      FROM (SELECT DISTINCT user_id, event_type FROM events) d GROUP BY user_id)
SELECT 'https://quotes.example/page/' || CAST(r.start AS VARCHAR) || '/' AS start_url, r.depth,
  CAST(row_number() OVER (PARTITION BY r.start, r.page ORDER BY u.user_id) - 1 AS INTEGER) AS pos,
  '“Events of user ' || CAST(u.user_id AS VARCHAR) || '”' AS text, 'User ' || CAST(u.user_id AS VARCHAR) AS author, u.tags
FROM r JOIN u ON u.page = r.page""")
def q_quotes_chain(spark, sf):
    """Quotes in the order a reader of the chain sees them. Pages 0, 5, 10, ... are
    starts, so chains merge: a later page belongs to two starts."""
    from gleanspark.functions.urls import prefix_url
    from gleanspark.operators.chain import chain_order
    from gleanspark.operators.extract import extract
    from gleanspark.plans import sites
    from gleanspark.plans.specs import NEXT_LINK
    pages = render.quote_pages(table(spark, sf, "events"))
    base = "https://quotes.example"
    links = extract(pages.select("url", "html"), NEXT_LINK, keep=("url",))
    edges = links.select(prefix_url("url", base).alias("url"), prefix_url("next_href", base).alias("next_url"))
    starts = pages.filter(F.col("page") % 5 == 0).select(prefix_url("url", base).alias("url"))
    walk = chain_order(edges, starts)
    records = sites.quotes(pages).withColumn("url", F.concat(
        F.lit(f"{base}/page/"), F.col("page").cast("string"), F.lit("/")))
    return walk.join(records, "url").select("start_url", "depth", "pos", "text", "author", "tags")


@register("resume_union", """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value ELSE value + 1000 END AS value FROM events""")
def q_resume_union(spark, sf):
    """Stored rows (events before Jan 16) win over a re-captured batch (events
    from Jan 11, values changed) for the same key."""
    from gleanspark.operators.dedup import union_keep_stored
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    stored = e.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).select("event_id", "value")
    new = e.filter(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz")) \
        .select("event_id", (F.col("value") + 1000).alias("value"))
    return union_keep_stored(stored, new, "event_id")


# ---------------------------------------------------------------------------
# Incremental load on Structured Streaming

def _load_drops(spark, name, pages, n_drops, **load):
    """``pages`` (with a ``drop`` column) written once; each drop is then loaded in order by a
    run of its own (own checkpoint) into one sink."""
    import uuid

    from gleanspark.session import scratch_path
    from gleanspark.streaming.incremental import incremental_load
    root = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    pages.write.partitionBy("drop").parquet(f"{root}/source")
    for i in range(n_drops):
        incremental_load(spark, f"{root}/source/drop={i}", pages.drop("drop").schema, f"{root}/sink",
                         f"{root}/checkpoint-{i}", **load)
    return f"{root}/sink"


def listing_drops(spark, sf, n_drops: int = 3):
    """The sink of a load of listing pages that arrive in ``n_drops`` drops (page ranges in order)."""
    part = table(spark, sf, "part")
    lo, hi = part.agg(F.min("p_partkey"), F.max("p_partkey")).first()      # one row
    step = (hi // 40 - lo // 40) // n_drops + 1
    pages = render.listing_pages(part, url_by_name=True).withColumn(
        "drop", F.expr(f"cast((page - {lo // 40}) div {step} as int)"))
    return _load_drops(spark, "stream-listing", pages, n_drops, transform=lambda df: products.listing(df),
                       key="url", order=["page", "pos"], skip_key="page")


def stream_listing(spark, sf, n_drops: int = 3):
    """A streaming load per drop extracts the listing pages, keeps the first card per
    URL and appends only URLs not stored by an earlier drop."""
    from gleanspark.streaming.incremental import read_sink
    return read_sink(spark, listing_drops(spark, sf, n_drops)).select("page", "pos", "name", "price", "price_num", "url")


register("stream_incremental", ORACLE["dedup_first"])(stream_listing)


# ---------------------------------------------------------------------------
# Search suite (12 views), campaign products, run log

_SEARCH_CTE = f"""
s AS (
  SELECT p_partkey // 40 AS page,
    p_name || ' ' || CASE p_type WHEN 'STANDARD' THEN 'Gel Pen' WHEN 'ECONOMY' THEN 'ball pen set'
      WHEN 'PROMO' THEN 'KAWAII gel pen' WHEN 'SMALL' THEN 'Sanrio' WHEN 'LARGE' THEN 'notebook'
      ELSE 'kawaii sanrio ball pen' END AS name,
    '৳ ' || printf('%.2f', (p_retailprice - 900) * 4) AS price,
    round((p_retailprice - 900) * 4, 2) AS price_num,
    'https://shop.example/p/' || {_SLUG} || '-i' || CAST(p_partkey AS VARCHAR) || '.html' AS url
  FROM part WHERE p_size <= 45),
clean AS (SELECT name, price, price_num, url FROM s)"""


def _search_view(name):
    def fn(spark, sf):
        pages = render.search_pages(table(spark, sf, "part"))
        raw = products.listing_raw(pages)
        clean = products.search_clean(raw)
        return views.product_views(raw.select("raw_name", "raw_price", "url"), clean)[name]
    fn.__doc__ = f"J06 search suite view {name!r} (D05 bands, D06 keywords, H01-H04)."
    return fn


register("search_raw", f"WITH {_SEARCH_CTE} SELECT name AS raw_name, price AS raw_price, url FROM s")(_search_view("Raw"))
register("search_clean", f"WITH {_SEARCH_CTE} SELECT * FROM clean")(_search_view("Clean"))
register("search_cheapest", f"WITH {_SEARCH_CTE} SELECT * FROM clean")(_search_view("Cheapest"))
register("search_most_expensive", f"WITH {_SEARCH_CTE} SELECT * FROM clean")(_search_view("Most Expensive"))
register("search_under_100", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE price_num < 100")(_search_view("Under 100"))
register("search_100_to_300", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE price_num BETWEEN 100 AND 300")(_search_view("100 to 300"))
register("search_above_300", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE price_num > 300")(_search_view("Above 300"))
register("search_gel_pen", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE contains(lower(name), 'gel pen')")(_search_view("Gel Pen"))
register("search_ball_pen", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE contains(lower(name), 'ball pen')")(_search_view("Ball Pen"))
register("search_kawaii", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE contains(lower(name), 'kawaii')")(_search_view("Kawaii"))
register("search_sanrio", f"WITH {_SEARCH_CTE} SELECT * FROM clean WHERE contains(lower(name), 'sanrio')")(_search_view("Sanrio"))
register("search_top_cheapest_50", f"WITH {_SEARCH_CTE} SELECT * FROM clean ORDER BY price_num, url LIMIT 50")(_search_view("Top Cheapest 50"))


@register("campaign", f"""
WITH c AS (
  SELECT p_partkey // 40 AS page,
         row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) AS pos,
         p_name, p_type, p_size, CAST(floor(p_retailprice) AS BIGINT) AS cur,
         'https://shop.example/p/' || {_SLUG} || '.html?spm=cmp' AS url
  FROM part),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page, pos) AS rn FROM c)
SELECT p_name AS name,
  CASE WHEN p_type = 'MEDIUM' THEN '৳ ' || CAST(cur + p_size AS VARCHAR) ELSE '৳ ' || CAST(cur AS VARCHAR) END AS current_price,
  CASE WHEN p_type IN ('STANDARD', 'LARGE', 'PROMO') THEN '৳ ' || CAST(cur + p_size AS VARCHAR) END AS old_price,
  url
FROM f WHERE rn = 1 AND p_type NOT IN ('PROMO', 'SMALL')""")
def q_campaign(spark, sf):
    """Card = link (own @href), C03 urljoin keeping the query, F04 seen before
    validation, B20 no-discount swap, D01."""
    return products.campaign(render.campaign_pages(table(spark, sf, "part")))


@register("run_summary", f"""
WITH l AS ({ORACLE['listing_extract']})
SELECT count(*) AS rows, count(DISTINCT url) AS unique_keys, count(DISTINCT page) AS pages FROM l""")
def q_run_summary(spark, sf):
    """F07 + J10: the run log as one row (rows, unique URLs, pages with rows)."""
    from gleanspark.sources.sinks import run_summary
    return run_summary(q_listing_extract(spark, sf))


@register("cards_per_page", """
SELECT p_partkey // 40 AS page, CAST(count(CASE WHEN p_size <= 45 THEN 1 END) AS BIGINT) AS cards
FROM part GROUP BY 1""")
def q_cards_per_page(spark, sf):
    """valid cards per listing page, zero pages kept."""
    from gleanspark.sources.sinks import cards_per_page
    pages = render.listing_pages(table(spark, sf, "part"))
    return cards_per_page(products.listing(pages), pages)


@register("distinct_urls", f"""
SELECT DISTINCT url FROM ({ORACLE['dedup_first']}) d""")
def q_distinct_urls(spark, sf):
    """distinct non-null URLs of the listing (the detail work list)."""
    from gleanspark.sources.sinks import distinct_values
    pages = render.listing_pages(table(spark, sf, "part"), url_by_name=True)
    return distinct_values(products.listing(pages), "url")


@register("detail_counts_variant", f"""WITH {_LISTING_CTE}
SELECT url,
  CASE WHEN p_type IN ('STANDARD', 'LARGE', 'ECONOMY') THEN li.n
       WHEN p_type = 'SMALL' THEN li.n END AS rating_count,
  CASE WHEN p_type IN ('STANDARD', 'LARGE', 'ECONOMY') THEN li.answered END AS answered_questions
FROM lst JOIN li ON li.l_partkey = lst.p_partkey WHERE p_type <> 'PROMO'""")
def q_detail_counts_variant(spark, sf):
    """The case-sensitive ``Rating`` / ``Answered`` label test (both tests on every
    link) with the count-block fallback, on every captured detail page of a listed
    product."""
    part, li, supp = (table(spark, sf, t) for t in ("part", "lineitem", "supplier"))
    det = products.detail_table(render.detail_pages(part, li, supp), exclusive_counts=False)
    lst = products.listing(render.listing_pages(part)).select("url")
    return det.join(lst, "url", "left_semi").select("url", "rating_count", "answered_questions")


@register("stream_details", f"""WITH {_LISTING_CTE}
SELECT 'https://shop.example/p/' || regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') || '-i'
         || CAST(p_partkey AS VARCHAR) || '.html' AS url,
  CASE WHEN p_type <> 'MEDIUM' THEN li.rating END AS rating_score,
  CASE WHEN p_type <> 'MEDIUM' THEN li.n END AS rating_count,
  CASE WHEN p_type IN ('STANDARD', 'LARGE', 'ECONOMY') THEN li.answered END AS answered_questions,
  CASE WHEN p_type <> 'MEDIUM' THEN p_brand END AS brand,
  CASE WHEN p_type <> 'MEDIUM' THEN s_name END AS seller,
  CASE WHEN p_type <> 'MEDIUM' THEN p_type || ' ' || p_name || ' & more size ' || CAST(p_size AS VARCHAR) END AS description,
  p_type <> 'MEDIUM' AS extract_ok
FROM part JOIN li ON li.l_partkey = p_partkey LEFT JOIN supplier ON s_suppkey = li.supp
WHERE p_type <> 'PROMO'""")
def stream_details(spark, sf, n_drops: int = 3):
    """K01 + J04: captured detail pages land in ``n_drops`` drops; each micro-batch
    extracts details, keeps one row per URL and appends URLs not stored yet. Failed
    pages are stored with ``extract_ok`` false (they count as done, E04)."""
    part, li, supp = (table(spark, sf, t) for t in ("part", "lineitem", "supplier"))
    from gleanspark.streaming.incremental import read_sink
    pages = render.detail_pages(part, li, supp).withColumn("drop", F.pmod(F.hash("url"), F.lit(n_drops)))
    return read_sink(spark, _load_drops(
        spark, "stream-details", pages, n_drops, transform=lambda df: products.detail_table(df),
        key="url", order=[~F.col("extract_ok")], skip_key="url"))
