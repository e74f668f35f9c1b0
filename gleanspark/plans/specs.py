"""The extraction specs of the captured pipelines, as data.

Fixed values: the selectors, attribute names and rating words below name parts of the
captured pages and have to match them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanspark.functions.text import remove_chars
from gleanspark.operators.extract import ExtractSpec, Field

# Star-rating words of the catalogue and their numbers.
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

# search / listing (A): card = product item; first a[title] -> @title, @href;
# first span.ooOxS -> price. All three required and non-empty.
LISTING = ExtractSpec(
    "listing",
    card='div[data-qa-locator="product-item"]',
    card_end="</section>",
    fields=(
        Field("raw_name", "a[title]", attr="title"),
        Field("href", "a[title]", attr="href"),
        Field("raw_price", "span.ooOxS", mode="clean"),
    ),
    required=("href", "raw_name", "raw_price"),
)

# listing (B): same selectors, no non-empty check.
LISTING_LENIENT = ExtractSpec("listing_b", card=LISTING.card, card_end=LISTING.card_end,
                              fields=LISTING.fields)

# detail (A): one record per page; fallback chains per field; counts from the
# review-summary links (B17), with the count block as fallback.
DETAIL = ExtractSpec(
    "detail",
    card=None,
    fields=(
        Field("rating_text", ("span.score-average", "div.score span.score-average")),
        Field("summary_links", "a.pdp-review-summary__link", many=True),
        Field("count_text", ("div.count", "div.mod-rating div.count")),
        Field("brand", ("a.pdp-product-brand__brand-link", "div.pdp-product-brand a")),
        Field("seller", ("a.seller-name__detail-name", "div.seller-name__detail a")),
        Field("description", ("div.html-content.detail-content",
                              "div.html-content.detail-content article.lzd-article",
                              "article.lzd-article")),
    ),
)

# bookstore card: link to the book, title, author, stock, price block, card text.
BOOK = ExtractSpec(
    "book",
    card="div.books-wrapper__item",
    card_end="</main>",
    fields=(
        Field("href", 'a[href*="/book/"]', attr="href"),
        Field("raw_title", "h4.book-title", mode="space"),
        Field("raw_author", "p.book-author", mode="space"),
        Field("stock_text", "p.book-status", mode="space"),
        Field("price_text", "p.book-price", mode="space"),
        Field("strike_text", "p.book-price strike.original-price", mode="space"),
        Field("card_text", None, mode="space"),
    ),
)

# directory card: name, address (space-joined), phone from the icon-guarded block;
# the category comes from the page it was found on.
DIRECTORY = ExtractSpec(
    "directory",
    card="div.company",
    card_end="</main>",
    fields=(
        Field("name", "h3 a", mode="tight"),
        Field("address", "div.address", mode="space"),
        Field("phone", "div.s", has=("i.fa-phone", "span"), then="span", mode="tight"),
    ),
    required=("name", "address"),
)

# team table rows: typed cells keyed by class.
TEAM_TABLE = ExtractSpec(
    "team_table",
    card="tr.team",
    card_end="</table>",
    fields=(
        Field("name", "td.name", mode="strip"),
        Field("year", "td.year", mode="strip"),
        Field("wins", "td.wins", mode="strip"),
        Field("losses", "td.losses", mode="strip"),
        Field("ot_losses", "td.ot-losses", mode="strip"),
        Field("win_pct", "td.pct", mode="strip"),
        Field("gf", "td.gf", mode="strip"),
        Field("ga", "td.ga", mode="strip"),
        Field("diff", "td.diff", mode="strip"),
    ),
)

# quotes with tags (card-first), and the next link of the page chain.
QUOTE = ExtractSpec(
    "quote",
    card="div.quote",
    card_end="</main>",
    fields=(
        Field("text", "span.text", mode="tight"),
        Field("author", "small.author", mode="tight"),
        Field("tags", "a.tag", mode="tight", many=True),
    ),
)
# page-wide quote lists: raw texts, zipped by position
QUOTE_LISTS = ExtractSpec(
    "quote_lists",
    card=None,
    fields=(
        Field("text", "span.text", mode="raw", many=True),
        Field("author", "small.author", mode="raw", many=True),
    ),
)
NEXT_LINK = ExtractSpec("next", card=None, fields=(Field("next_href", "li.next a", attr="href"),))

# campaign card: the card is the link; its own href, title and two prices.
CAMPAIGN = ExtractSpec(
    "campaign",
    card="a.jfy-product-card-component-pc",
    card_end="</footer>|</div><footer",
    fields=(
        Field("href", None, attr="href"),
        Field("name", ".product-card-title", mode="clean"),
        Field("current_price", ".lzdPriceDiscountPCV2", mode="clean"),
        Field("old_price", ".lzdPriceOriginPCV2", mode="clean"),
    ),
)

# countries: page-wide parallel lists.
COUNTRIES = ExtractSpec(
    "countries",
    card=None,
    fields=(
        Field("name", "h3.country-name", mode="strip",
              post=lambda c: remove_chars(c, '"')),
        Field("capital", "span.country-capital", mode="raw"),
        Field("population", "span.country-population", mode="strip",
              post=lambda c: c.cast("double")),
        Field("area", "span.country-area", mode="strip", post=lambda c: c.cast("double")),
    ),
)

# catalogue: title from h3 a@title, price text, rating word from the class token.
CATALOGUE = ExtractSpec(
    "catalogue",
    card="article.product_pod",
    card_end="</ol>",
    fields=(
        Field("title", "h3 a", attr="title"),
        Field("price", "p.price_color", mode="strip"),
        Field("rating_word", "p.star-rating", attr="class",
              post=lambda c: F.nullif(F.regexp_extract(c, r"star-rating\s+(\w+)", 1), F.lit(""))),
    ),
)

# generic page reads on captured pages (title, nav links, article paragraphs).
PAGE_TITLE = ExtractSpec("title", card=None, fields=(Field("title", "title", mode="clean"),))
NAV_LINKS = ExtractSpec(
    "nav_links", card="nav li", card_end="</nav>",
    fields=(Field("href", "a", attr="href"), Field("text", "a", mode="clean")))
PARAGRAPHS = ExtractSpec(
    "paragraphs", card=None,
    fields=(Field("paras", "article p", mode="clean", many=True),))

__all__ = ["LISTING", "LISTING_LENIENT", "DETAIL", "BOOK", "DIRECTORY", "TEAM_TABLE", "QUOTE",
           "NEXT_LINK", "CAMPAIGN", "COUNTRIES", "CATALOGUE", "PAGE_TITLE", "NAV_LINKS", "PARAGRAPHS"]
