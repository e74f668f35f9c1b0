"""Captured-page tables derived from the driver tables with Spark string functions.

The pipelines start from captured pages; to check them against plain SQL at any
scale, these functions render pages from the TPC-H-ish tables (the product is
``part``, a detail page is ``lineitem`` grouped by part, a place is a ``customer``,
...). Every page groups a bounded number of rows (``per_page``), ordered by key, so
no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.plans.specs import RATING_WORDS

BASE = "https://shop.example"


def esc(c) -> Column:
    """HTML-escape text for an attribute or text node."""
    c = F.col(c) if isinstance(c, str) else c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def slug(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")


def group_pages(cards: DataFrame, page_col: str, order_col: str, frag_col: str,
                head: str, tail: str, extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """Concatenate card fragments into one page per ``page_col``, in ``order_col`` order.

    The group of a page is bounded by construction (``key div per_page``); the sort
    is inside the group (``array_sort`` of structs), not a global sort.
    """
    agg = cards.groupBy(page_col, *extra_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("k"),
                                             F.col(frag_col).alias("f")))).alias("_cards"))
    body = F.array_join(F.transform("_cards", lambda x: x["f"]), "")
    return agg.select(F.col(page_col).alias("page"), *extra_cols,
                      F.concat(F.lit(head), body, F.lit(tail)).alias("html"))


# Page chrome shared by the rendered listing pages: a script holding card-like
# markup, a comment, an entity, an unclosed <p>, nested whitespace.
LISTING_HEAD = (
    '<!DOCTYPE html><html><head><title>Results &amp; offers</title>'
    '<script>var tpl = \'<div data-qa-locator="product-item"><a title="fake" href="/x">'
    '</a><span class="ooOxS">৳ 1</span></div>\';</script></head><body>'
    '<header><p>Showing   items\n <b>now</header><!-- <div data-qa-locator="product-item"> -->'
    '<section class="grid">')
LISTING_TAIL = '</section><footer><span class="ooOxS">৳ 0</span> footer</footer></body></html>'


def listing_pages(part: DataFrame, per_page: int = 40, url_by_name: bool = False,
                  name=None, price=None) -> DataFrame:
    """Search/listing pages rendered from ``part``: one card per part, ``per_page``
    cards per page (page = p_partkey div per_page). Parts with ``p_size > 45`` carry no
    price element (an invalid card). With ``url_by_name`` the link depends on the name
    only (plus a query string), so equal names give equal normalized URLs."""
    href = (F.concat(F.lit("//shop.example/p/"), slug("p_name"), F.lit(".html?spm="),
                     F.col("p_partkey").cast("string"))
            if url_by_name else
            F.concat(F.lit("//shop.example/p/"), slug("p_name"), F.lit("-i"),
                     F.col("p_partkey").cast("string"), F.lit(".html?q=1")))
    name = F.col("p_name") if name is None else name
    amount = F.col("p_retailprice") if price is None else price
    price = F.when(F.col("p_size") <= 45, F.concat(
        F.lit('<span class="ooOxS">  ৳ '), F.format_number(amount, 2), F.lit(" </span>")
    )).otherwise(F.lit(""))
    card = F.concat(
        F.lit('\n<div class="c" data-qa-locator="product-item"><div class="img"><a href="'),
        esc(href), F.lit('"><img src="x.jpg"></a></div><div class="info"><a title="'),
        esc(name), F.lit('" href="'), esc(href), F.lit('">'), esc(name),
        F.lit("</a>"), price, F.lit("</div></div>"))
    cards = part.select(F.floor(F.col("p_partkey") / per_page).alias("page"),
                        "p_partkey", card.alias("card"))
    return group_pages(cards, "page", "p_partkey", "card", LISTING_HEAD, LISTING_TAIL)


def detail_stats(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Per-part review figures from ``lineitem`` (partial aggregation, one shuffle on
    ``l_partkey``): rating = floor(avg quantity) / 10, count, answered = returned lines,
    seller = name of the lowest supplier key."""
    agg = lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"),
        (F.floor(F.avg("l_quantity")) / 10.0).alias("rating"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("answered"),
        F.min("l_suppkey").alias("supp"))
    return agg.join(supplier.select(F.col("s_suppkey").alias("supp"), "s_name"), "supp", "left")


def detail_pages(part: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """One captured detail page per part, by ``p_type``:
    STANDARD/LARGE full page; ECONOMY fallback selectors only; SMALL count block
    instead of review links; MEDIUM an empty (failed) page; PROMO not captured."""
    st = detail_stats(lineitem, supplier)
    p = part.filter(F.col("p_type") != "PROMO").join(
        st, F.col("p_partkey") == F.col("l_partkey"), "inner")
    url = F.concat(F.lit(BASE + "/p/"), slug("p_name"), F.lit("-i"),
                   F.col("p_partkey").cast("string"), F.lit(".html"))
    rating = F.concat(F.lit('<div class="score"><span class="score-average"> '),
                      F.col("rating").cast("string"), F.lit(" </span><span>/5</span></div>"))
    links = F.concat(
        F.lit('<a class="pdp-review-summary__link" href="#r">'), F.col("n").cast("string"),
        F.lit(' Ratings</a><a class="pdp-review-summary__link" href="#q">'),
        F.col("answered").cast("string"), F.lit(" Answered Questions</a>"))
    count_block = F.concat(F.lit('<div class="mod-rating"><div class="count">'),
                           F.col("n").cast("string"), F.lit(" ratings</div></div>"))
    desc = F.concat(F.lit("<p>"), esc("p_type"), F.lit(" "), esc("p_name"),
                    F.lit(" &amp; more<br>\n   size "), F.col("p_size").cast("string"), F.lit("</p>"))
    full = F.concat(
        rating, links,
        F.lit('<div class="pdp-product-brand"><a class="pdp-product-brand__brand-link" href="/b">'),
        esc("p_brand"), F.lit("</a></div>"),
        F.lit('<div class="seller-name__detail"><a class="seller-name__detail-name" href="/s">'),
        esc("s_name"), F.lit("</a></div>"),
        F.lit('<div class="html-content detail-content">'), desc, F.lit("</div>"))
    fallback = F.concat(
        rating, links,
        F.lit('<div class="pdp-product-brand"><span>Brand:</span> <a href="/b">'), esc("p_brand"),
        F.lit("</a></div>"),
        F.lit('<div class="seller-name__detail"><a href="/s">'), esc("s_name"), F.lit("</a></div>"),
        F.lit('<article class="lzd-article">'), desc, F.lit("</article>"))
    counts_only = F.concat(
        rating, count_block,
        F.lit('<div class="pdp-product-brand"><a class="pdp-product-brand__brand-link" href="/b">'),
        esc("p_brand"), F.lit("</a></div>"),
        F.lit('<div class="seller-name__detail"><a class="seller-name__detail-name" href="/s">'),
        esc("s_name"), F.lit("</a></div>"),
        F.lit('<div class="html-content detail-content">'), desc, F.lit("</div>"))
    body = (F.when(F.col("p_type").isin("STANDARD", "LARGE"), full)
            .when(F.col("p_type") == "ECONOMY", fallback)
            .when(F.col("p_type") == "SMALL", counts_only)
            .otherwise(F.lit("<p>This page is not available</p>")))
    html = F.concat(F.lit('<html><head><script>var x="<span class=\\"score-average\\">9</span>";'
                          "</script></head><body><div class=\"pdp\"><h1>"), esc("p_name"),
                    F.lit("</h1>"), body, F.lit("</div></body></html>"))
    return p.select(url.alias("url"), html.alias("html"))


def team_pages(supplier: DataFrame, per_page: int = 25) -> DataFrame:
    """Team-table pages from ``supplier``: one ``tr.team`` per supplier, typed cells keyed
    by class; a negative balance leaves the OT-losses and win-% cells empty."""
    neg = F.col("s_acctbal") < 0
    cell = lambda cls, v: F.concat(F.lit(f'<td class="{cls}">\n      '), v, F.lit("\n    </td>"))
    row = F.concat(
        F.lit('\n<tr class="team">'),
        cell("name", esc("s_name")),
        cell("year", (F.col("s_nationkey") + 1990).cast("string")),
        cell("wins", (F.col("s_nationkey") + 10).cast("string")),
        cell("losses", F.col("s_nationkey").cast("string")),
        cell("ot-losses", F.when(neg, F.lit("")).otherwise(F.col("s_nationkey").cast("string"))),
        F.when(neg, F.lit('<td class="pct"></td>')).otherwise(
            cell("pct", (F.col("s_acctbal") / 10000.0).cast("string"))),
        cell("gf", (F.col("s_nationkey") * 3).cast("string")),
        cell("ga", (F.col("s_nationkey") * 2).cast("string")),
        cell("diff", F.col("s_nationkey").cast("string")),
        F.lit("</tr>"))
    cards = supplier.select(F.floor(F.col("s_suppkey") / per_page).alias("page"), "s_suppkey",
                            row.alias("card"))
    return group_pages(cards, "page", "s_suppkey", "card",
                       '<html><body><table class="table"><tr><th>Team Name</th><th>Year</th></tr>',
                       "</table><p>Per page</p></body></html>")


def nested_team_pages(supplier: DataFrame, per_page: int = 25) -> DataFrame:
    """Team pages as old sites write them: attributes without quotes, cells and rows that are
    never closed, and a table of two rows inside every name cell."""
    row = F.concat(
        F.lit("\n<tr class=team><td class=name>"), esc("s_name"),
        F.lit(" <table><tr class=home><td class=from>nation "), F.col("s_nationkey").cast("string"),
        F.lit("<tr><td>key "), F.col("s_suppkey").cast("string"), F.lit("</table> club"),
        *[x for cls, v in (("year", F.col("s_nationkey") + 1990), ("wins", F.col("s_nationkey") + 10),
                           ("losses", F.col("s_nationkey")), ("ot-losses", F.lit("")), ("pct", F.lit("0.5")),
                           ("gf", F.col("s_nationkey") * 3), ("ga", F.col("s_nationkey") * 2),
                           ("diff", F.col("s_nationkey")))
          for x in (F.lit(f"<td class={cls}>"), v.cast("string"))])
    cards = supplier.select(F.floor(F.col("s_suppkey") / per_page).alias("page"), "s_suppkey", row.alias("card"))
    return group_pages(cards, "page", "s_suppkey", "card", "<html><body><table class=table><tr><th>Team", "</table>")


def menu_pages(supplier: DataFrame, per_page: int = 50, per_menu: int = 10) -> DataFrame:
    """Pages of a menu of menus: an outer item names its group, holds a list of linked items
    that are never closed, and goes on behind it."""
    item = F.concat(F.lit("<li class='item sub'><a href=/s/"), F.col("s_suppkey").cast("string"), F.lit("?a=1&amp;b=2>"),
                    esc("s_name"), F.lit("</a>"))
    inner = supplier.select(F.floor(F.col("s_suppkey") / per_menu).alias("menu"), "s_suppkey", item.alias("card"))
    menus = group_pages(inner, "menu", "s_suppkey", "card", "<ul>", "</ul>")
    outer = menus.select((F.col("page") * per_menu / per_page).cast("long").alias("p"), F.col("page").alias("menu"),
                         F.concat(F.lit("\n<li class=item>Group "), F.col("page").cast("string"), "html",
                                  F.lit(" end</li>")).alias("card"))
    return group_pages(outer, "p", "menu", "card", "<nav><ul id=top>", "</ul></nav><ul><li class=item>other</ul>")


def country_pages(customer: DataFrame, nation: DataFrame, per_page: int = 50) -> DataFrame:
    """Pages of four page-wide parallel lists (B06), one page per nation and customer
    key bucket (at most ``per_page`` entries): quoted customer name, the nation's
    capital line, a population figure from the key and an area from the balance."""
    n = customer.join(nation.select("n_nationkey", "n_name"),
                      F.col("c_nationkey") == F.col("n_nationkey"))
    frag = F.concat(
        F.lit('\n<div class="country"><h3 class="country-name">\n  <i class="flag"></i>\n  "'),
        esc("c_name"), F.lit('"\n</h3><div class="country-info"><strong>Capital:</strong>'
                             '<span class="country-capital"> Capital of '), esc("n_name"),
        F.lit('</span><br><strong>Population:</strong><span class="country-population">'),
        (F.col("c_custkey") * 1000 + 5).cast("string"),
        F.lit('</span><br><strong>Area (km<sup>2</sup>):</strong><span class="country-area"> '),
        F.col("c_acctbal").cast("string"), F.lit("</span></div></div>"))
    page = F.concat(F.col("n_name"), F.lit("-"), F.floor(F.col("c_custkey") / per_page).cast("string"))
    cards = n.select(page.alias("page"), "c_custkey", frag.alias("card"))
    return group_pages(cards, "page", "c_custkey", "card", "<html><body><section>",
                       "</section></body></html>")


def catalogue_pages(part: DataFrame, per_page: int = 20) -> DataFrame:
    """Catalogue pages from ``part``: title attribute, price text, star-rating word
    (``p_size mod 5 + 1``)."""
    word = F.element_at(F.array(*[F.lit(w) for w in RATING_WORDS]), (F.col("p_size") % 5 + 1).cast("int"))
    card = F.concat(
        F.lit('\n<li><article class="product_pod"><p class="star-rating '), word,
        F.lit('"><i class="icon-star"></i></p><h3><a href="catalogue/'), slug("p_name"),
        F.lit("_"), F.col("p_partkey").cast("string"), F.lit('/index.html" title="'), esc("p_name"),
        F.lit('">'), esc(F.substring("p_name", 1, 5)), F.lit('...</a></h3><div class="product_price">'
                                                          '<p class="price_color">  £'),
        F.format_number("p_retailprice", 2), F.lit("  </p></div></article></li>"))
    cards = part.select(F.floor(F.col("p_partkey") / per_page).alias("page"), "p_partkey",
                        card.alias("card"))
    return group_pages(cards, "page", "p_partkey", "card", '<html><body><ol class="row">',
                       "</ol></body></html>")


def quote_pages(events: DataFrame, per_page: int = 10, chain_len: int = 10) -> DataFrame:
    """Quote pages from ``events``: one ``div.quote`` per user with the user's distinct
    event types as tags; page = user_id div per_page. Pages are chained by a
    ``li.next`` link in runs of ``chain_len`` (a new site starts every run).

    Distinct (user, type) pairs are formed first (partial aggregation), so a user's
    tag list is bounded by the number of event types, however many events it has.
    """
    pairs = events.select("user_id", "event_type").distinct()
    tags = pairs.groupBy("user_id").agg(F.array_sort(F.collect_list("event_type")).alias("tags"))
    tag_html = F.array_join(F.transform("tags", lambda t: F.concat(
        F.lit('<a class="tag" href="/tag/'), t, F.lit('/">'), esc(t), F.lit("</a>"))), " ")
    card = F.concat(
        F.lit('\n<div class="quote"><span class="text">  “Events of user '),
        F.col("user_id").cast("string"), F.lit('”</span><span>by <small class="author">User '),
        F.col("user_id").cast("string"), F.lit('</small></span><div class="tags"> Tags: '),
        tag_html, F.lit("</div></div>"))
    cards = tags.select(F.floor(F.col("user_id") / per_page).alias("page"), "user_id",
                        card.alias("card"))
    pages = group_pages(cards, "page", "user_id", "card", "<html><body><main>", "</main>")
    # a page links to the next one when that page exists and the run goes on
    nxt_exists = pages.select((F.col("page") - 1).alias("page"), F.lit(True).alias("has_next"))
    nxt = F.when(((F.col("page") + 1) % chain_len != 0) & F.col("has_next").isNotNull(),
                 F.concat(F.lit('<nav><ul class="pager"><li class="next"><a href="/page/'),
                          (F.col("page") + 1).cast("string"), F.lit('/">Next</a></li></ul></nav>'))
                 ).otherwise(F.lit(""))
    return pages.join(nxt_exists, "page", "left") \
        .select("page", F.concat(F.lit("/page/"), F.col("page").cast("string"), F.lit("/")).alias("url"),
                F.concat("html", nxt, F.lit("</body></html>")).alias("html"))


def book_pages(part: DataFrame, per_page: int = 30) -> DataFrame:
    """Bookstore search pages from ``part``. Price blocks by ``p_type``: STANDARD old +
    current; ECONOMY current only; SMALL struck price only; MEDIUM ``Free``; LARGE two
    prices without strike; PROMO like STANDARD with a decimal current price. The
    bracketed count is ``p_size - 10`` when positive. PROMO and LARGE titles carry
    keywords for the regex views."""
    cur = (F.floor("p_retailprice").cast("int") - 900) * 6
    old = cur + F.col("p_size") * 5
    tk = lambda v: F.concat(F.lit("TK. "), v.cast("string"))
    block = (F.when(F.col("p_type") == "STANDARD", F.concat(
                F.lit('<strike class="original-price">'), tk(old), F.lit("</strike> "), tk(cur)))
             .when(F.col("p_type") == "ECONOMY", tk(cur))
             .when(F.col("p_type") == "SMALL", F.concat(
                 F.lit('<strike class="original-price">'), tk(old), F.lit("</strike>")))
             .when(F.col("p_type") == "MEDIUM", F.lit("Free"))
             .when(F.col("p_type") == "LARGE", F.concat(tk(old), F.lit(" "), tk(cur)))
             .otherwise(F.concat(F.lit('<strike class="original-price">'), tk(old),
                                 F.lit("</strike> "), tk(cur), F.lit(".50"))))
    title = (F.when(F.col("p_type") == "PROMO", F.concat(esc("p_name"), F.lit(" Quran   Tafsir")))
             .when(F.col("p_type") == "LARGE", F.concat(esc("p_name"), F.lit(" হাদিস সংকলন")))
             .otherwise(esc("p_name")))
    count = F.when(F.col("p_size") > 10, F.concat(
        F.lit('<span class="rating">('), (F.col("p_size") - 10).cast("string"), F.lit(")</span>"))
    ).otherwise(F.lit(""))
    card = F.concat(
        F.lit('\n<div class="books-wrapper__item"><a href="/book/'), F.col("p_partkey").cast("string"),
        F.lit("/"), slug("p_name"), F.lit('?ref=sr"><img src="c.jpg"></a><div class="book-text-area">'
                                          '<h4 class="book-title">\n  '), title,
        F.lit(' </h4><p class="book-author"> '), esc("p_brand"), F.lit('</p><p class="book-status">'),
        F.when(F.col("p_size") > 25, F.lit("In Stock")).otherwise(F.lit("Out of   stock")),
        F.lit('</p>'), count, F.lit('<p class="book-price">'), block, F.lit("</p></div></div>"))
    cards = part.select(F.floor(F.col("p_partkey") / per_page).alias("page"), "p_partkey",
                        card.alias("card"))
    return group_pages(cards, "page", "p_partkey", "card",
                       '<html><body><main><div class="books-wrapper">', "</div></main></body></html>")


def directory_pages(customer: DataFrame, nation: DataFrame, per_page: int = 20) -> DataFrame:
    """Directory pages from ``customer`` in two categories (by market segment). The
    last card of a page is repeated on the next page (pagination drift), which the
    4-column dedup removes. City by region: three Dhaka regions, one that also names
    Sylhet, one in Chittagong. No phone block for a negative balance; no name for
    AUTOMOBILE customers of nations 0-4."""
    c = customer.join(nation.select("n_nationkey", "n_name", "n_regionkey"),
                      F.col("c_nationkey") == F.col("n_nationkey"))
    city = F.element_at(F.array(F.lit("Dhaka"), F.lit("Dhaka-1207"), F.lit("DHAKA"),
                                F.lit("Dhaka Road, Sylhet"), F.lit("Chittagong")),
                        (F.col("n_regionkey") + 1).cast("int"))
    category = F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"),
                      F.lit("Vehicle services")).otherwise(F.lit("Restaurant"))
    no_name = (F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_nationkey") < 5)
    phone = F.when(F.col("c_acctbal") >= 0, F.concat(
        F.lit('<div class="s"><i class="fa fa-phone"></i><span> +880 '),
        F.col("c_custkey").cast("string"), F.lit(" </span></div>"))).otherwise(F.lit(""))
    card = F.concat(
        F.lit('\n<div class="company"><h3>'),
        F.when(no_name, F.lit("")).otherwise(F.concat(
            F.lit('<a href="/company/'), F.col("c_custkey").cast("string"), F.lit('">\n   '),
            esc("c_name"), F.lit("  </a>"))),
        F.lit('</h3><div class="address"><span>House '), F.col("c_custkey").cast("string"),
        F.lit(",</span>\n <span>"), esc("n_name"), F.lit("</span>, "), city, F.lit("</div>"),
        F.lit('<div class="s"><i class="fa fa-globe"></i><span>web</span></div>'), phone,
        F.lit("</div>"))
    base = c.select(category.alias("category"), F.floor(F.col("c_custkey") / per_page).alias("page"),
                    "c_custkey", card.alias("card"),
                    (F.col("c_custkey") % per_page == per_page - 1).alias("_last"))
    dup = base.filter("_last").withColumn("page", F.col("page") + 1) \
        .withColumn("c_custkey", F.col("c_custkey") - per_page * 1000000)
    cards = base.unionByName(dup).drop("_last")
    return group_pages(cards, "page", "c_custkey", "card", "<html><body><main>",
                       "</main></body></html>", extra_cols=("category",))


# Fixed mapping used to derive place attributes from the market segment.
SEGMENT_KIND = {"HOUSEHOLD": "Grill", "MACHINERY": "Fried Chicken", "FURNITURE": "Cafe",
                "BUILDING": "Fast Food", "AUTOMOBILE": "Burgers"}
SEGMENT_LEVEL = {"AUTOMOBILE": "PRICE_LEVEL_FREE", "BUILDING": "PRICE_LEVEL_INEXPENSIVE",
                 "FURNITURE": "PRICE_LEVEL_MODERATE", "MACHINERY": "PRICE_LEVEL_EXPENSIVE",
                 "HOUSEHOLD": "PRICE_LEVEL_VERY_EXPENSIVE"}
REGION_AREA = ["Gulshan 2, Dhaka", "Dhanmondi, Dhaka", "Uttara Sector 4, Dhaka",
               "Banani, Dhaka", "Agrabad, Chattogram"]


def _lit_map(d: dict):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def place_facts(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """One row of place facts per customer: kind word, level code, rating
    ((floor(balance / 1000) + 1) / 2, none for a negative balance), review count =
    number of orders (none without orders), address by region."""
    n_orders = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    c = (customer.join(nation.select("n_nationkey", "n_regionkey"),
                       F.col("c_nationkey") == F.col("n_nationkey"))
         .join(n_orders, "c_custkey", "left"))
    level = F.try_element_at(_lit_map(SEGMENT_LEVEL), F.col("c_mktsegment"))
    lvl_num = (F.when(level == "PRICE_LEVEL_INEXPENSIVE", 1).when(level == "PRICE_LEVEL_MODERATE", 2)
               .when(level == "PRICE_LEVEL_EXPENSIVE", 3).when(level == "PRICE_LEVEL_VERY_EXPENSIVE", 4))
    money = lambda units: F.struct(F.lit("BDT").alias("currencyCode"), units.cast("string").alias("units"),
                                   F.lit("500000000").alias("nanos"))
    return c.select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("id"),
        "c_custkey", "c_nationkey", "n_regionkey", "c_mktsegment",
        F.concat(F.col("c_name"), F.lit("  "), F.try_element_at(_lit_map(SEGMENT_KIND), F.col("c_mktsegment"))).alias("name"),
        F.concat(F.lit("House "), F.col("c_custkey").cast("string"), F.lit(", Road "),
                 F.col("c_nationkey").cast("string"), F.lit(",  "),
                 F.element_at(F.array(*[F.lit(a) for a in REGION_AREA]), (F.col("n_regionkey") + 1).cast("int"))
                 ).alias("address"),
        level.alias("level"),
        F.when(lvl_num.isNotNull(), F.struct(money(lvl_num * 100).alias("startPrice"),
                                             money(lvl_num * 200).alias("endPrice"))).alias("price_range"),
        F.when(F.col("c_acctbal") >= 0, (F.floor(F.col("c_acctbal") / 1000) + 1) / 2.0).alias("rating"),
        F.col("n_orders").alias("rating_count"),
        F.concat(F.lit("https://maps.example/?cid="), F.col("c_custkey").cast("string")).alias("maps"),
    )


def place_search_table(customer: DataFrame, nation: DataFrame, region: DataFrame,
                       orders: DataFrame, per_bucket: int = 1000) -> DataFrame:
    """Search response pages ``(query, query_idx, page_idx, body)``: one query per
    nation (``query_idx`` = nation key) and one per region (100 + region key), so
    every place is returned twice. A page holds the places of one key bucket
    (``c_custkey div per_bucket``), so its size is bounded. Search results leave out
    the name for nation 1, the level for nation 2, the rating for nation 3 and the
    price range for nation 4 (the detail fills them in)."""
    f = place_facts(customer, nation, orders)
    place = F.struct(
        F.col("id"),
        F.when(F.col("c_nationkey") != 1, F.struct(F.col("name").alias("text"))).alias("displayName"),
        F.col("address").alias("formattedAddress"),
        F.when(F.col("c_nationkey") != 2, F.col("level")).alias("priceLevel"),
        F.when(F.col("c_nationkey") != 4, F.col("price_range")).alias("priceRange"),
        F.when(F.col("c_nationkey") != 3, F.col("rating")).alias("rating"),
        F.col("rating_count").alias("userRatingCount"),
        F.col("maps").alias("googleMapsUri"))
    bucket = F.floor(F.col("c_custkey") / per_bucket).cast("int")
    rows = f.select(bucket.alias("page_idx"), "c_custkey", "c_nationkey", "n_regionkey", place.alias("pl"))
    by_nation = rows.select(F.col("c_nationkey").alias("query_idx"), "page_idx", "c_custkey", "pl")
    by_region = rows.select((F.col("n_regionkey") + 100).alias("query_idx"), "page_idx", "c_custkey", "pl")
    both = by_nation.unionByName(by_region)
    pages = both.groupBy("query_idx", "page_idx").agg(
        F.array_sort(F.collect_list(F.struct(F.col("c_custkey").alias("k"), F.col("pl").alias("p")))).alias("_l"))
    names = (nation.select(F.col("n_nationkey").alias("query_idx"), F.col("n_name").alias("q"))
             .unionByName(region.select((F.col("r_regionkey") + 100).alias("query_idx"), F.col("r_name").alias("q"))))
    pages = pages.join(names, "query_idx")
    body = F.to_json(F.struct(F.transform("_l", lambda x: x["p"]).alias("places"),
                              F.concat(F.lit("tok-"), F.col("page_idx").cast("string")).alias("nextPageToken")))
    return pages.select(F.concat(F.lit("burger in "), F.col("q")).alias("query"),
                        F.col("query_idx").cast("int").alias("query_idx"), "page_idx", body.alias("body"))


def place_detail_table(customer: DataFrame, nation: DataFrame, orders: DataFrame,
                       pages: DataFrame) -> DataFrame:
    """Detail responses ``(id, status, body)``: status 404 for nation 5. Phones:
    HOUSEHOLD only an international number. Websites: none for AUTOMOBILE, a
    Facebook page for HOUSEHOLD, an Instagram page for MACHINERY, else the captured
    page whose ``page_id`` is the customer key (none when there is no such page)."""
    f = place_facts(customer, nation, orders)
    site = pages.select(F.col("page_id").alias("c_custkey"), F.col("url").alias("page_url"))
    f = f.join(site, "c_custkey", "left")
    web = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string"))
           .when(F.col("c_mktsegment") == "HOUSEHOLD",
                 F.concat(F.lit("https://facebook.com/p"), F.col("c_custkey").cast("string")))
           .when(F.col("c_mktsegment") == "MACHINERY",
                 F.concat(F.lit("https://www.instagram.com/p"), F.col("c_custkey").cast("string")))
           .otherwise(F.col("page_url")))
    body = F.to_json(F.struct(
        F.col("id"), F.struct(F.col("name").alias("text")).alias("displayName"),
        F.col("address").alias("formattedAddress"), F.col("level").alias("priceLevel"),
        F.col("price_range").alias("priceRange"), F.col("rating"),
        F.col("rating_count").alias("userRatingCount"), F.col("maps").alias("googleMapsUri"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD",
               F.concat(F.lit("01"), F.col("c_custkey").cast("string"))).alias("nationalPhoneNumber"),
        F.concat(F.lit("+880 1"), F.col("c_custkey").cast("string")).alias("internationalPhoneNumber"),
        web.alias("websiteUri")))
    return f.select("id", F.when(F.col("c_nationkey") == 5, 404).otherwise(200).alias("status"),
                    body.alias("body"))


# Keywords carried by the names of the search-suite pages, by part type.
SEARCH_DECOR = {"STANDARD": "Gel Pen", "ECONOMY": "ball pen set", "PROMO": "KAWAII gel pen",
                "SMALL": "Sanrio", "LARGE": "notebook", "MEDIUM": "kawaii sanrio ball pen"}


def search_pages(part: DataFrame, per_page: int = 40) -> DataFrame:
    """Search-suite pages: names carry the view keywords by part type, prices are
    ``(p_retailprice - 900) * 4`` so they span the 100/300 bands."""
    name = F.concat(F.col("p_name"), F.lit(" "), F.try_element_at(_lit_map(SEARCH_DECOR), F.col("p_type")))
    return listing_pages(part, per_page, url_by_name=False, name=name,
                         price=(F.col("p_retailprice") - 900) * 4)


def campaign_pages(part: DataFrame, per_page: int = 40) -> DataFrame:
    """Campaign pages: the card is the link itself; the URL depends on the name only.
    Prices by type: STANDARD/LARGE/PROMO discount + origin, ECONOMY discount only,
    MEDIUM origin only (no discount), SMALL none. PROMO cards have no title."""
    href = F.concat(F.lit("//shop.example/p/"), slug("p_name"), F.lit(".html?spm=cmp"))
    cur = F.concat(F.lit('<span class="lzdPriceDiscountPCV2">৳ '),
                   F.floor("p_retailprice").cast("string"), F.lit("</span>"))
    old = F.concat(F.lit('<del class="lzdPriceOriginPCV2">৳ '),
                   (F.floor("p_retailprice") + F.col("p_size")).cast("string"), F.lit("</del>"))
    t = F.col("p_type")
    prices = (F.when(t.isin("STANDARD", "LARGE", "PROMO"), F.concat(cur, old))
              .when(t == "ECONOMY", cur).when(t == "MEDIUM", old).otherwise(F.lit("")))
    title = F.when(t != "PROMO", F.concat(F.lit('<div class="product-card-title">\n '), esc("p_name"),
                                            F.lit(" </div>"))).otherwise(F.lit(""))
    card = F.concat(F.lit('\n<a class="jfy-product-card-component-pc" href="'), esc(href),
                    F.lit('"><div class="card">'), title, F.lit('<div class="price">'), prices,
                    F.lit("</div></div></a>"))
    cards = part.select(F.floor(F.col("p_partkey") / per_page).alias("page"), "p_partkey", card.alias("card"))
    return group_pages(cards, "page", "p_partkey", "card", '<html><body><div class="jfy">',
                       '</div><footer><a href="/help">Help</a></footer></body></html>')
