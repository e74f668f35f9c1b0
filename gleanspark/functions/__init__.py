"""Column functions: every cleaning, parsing and classing rule as a native expression."""

from gleanspark.functions.classify import (area_class, bucket, contains_ci, home_city_address,
                                           is_blocked, is_logged_in, keyword_class, place_kind,
                                           price_category, rating_category, website_type)
from gleanspark.functions.numbers import (bracket_count, clean_float, clean_int, coerce_double,
                                          map_lookup, money_to_text, price_block, price_first,
                                          price_marker, price_range_text, price_strict,
                                          strict_cast, swap_if_no_discount, zero_if_empty)
from gleanspark.functions.score import level_score, value_score
from gleanspark.functions.text import (clean_all_text_columns, clean_text, extract_email,
                                       first_truthy, html_text, html_unescape, is_nonempty,
                                       remove_chars, safe_lower, strip_noise, strip_text)
from gleanspark.functions.urls import (get_domain, is_http_url, normalize_url, prefix_url,
                                       quote_query, strip_url, url_join)

__all__ = [n for n in dir() if not n.startswith("_")]
