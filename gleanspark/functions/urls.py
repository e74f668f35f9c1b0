"""URL column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions._util import col_of

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"
# a scheme without an authority (mailto:, tel:, javascript:) is no path of the base
_OPAQUE = r"^(?!(?i:https?):)[A-Za-z][A-Za-z0-9+.-]*:(?!//)"
_DOTS = r"(^|/)\.\.?(/|$)"


def _lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def quote_query(q) -> Column:
    """Percent-encode a query string the way ``urllib.parse.quote`` does
    (space -> ``%20``, ``/`` and ``~`` kept, ``*`` encoded)."""
    enc = F.url_encode(_lit_or_col(q))
    for a, b in (("+", "%20"), ("%7E", "~"), ("%2F", "/"), ("*", "%2A")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    return enc


def _resolve_segments(segs: Column) -> Column:
    """RFC 3986 dot-segment removal over path segments (as ``urljoin`` does): ``..``
    drops the previous segment (never past the root), ``.`` is skipped, a trailing
    ``.``/``..`` leaves a trailing slash. A fold over the segment array, exact for any
    depth."""
    empty = F.array().cast("array<string>")
    resolved = F.aggregate(
        segs, empty,
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x))))
    resolved = F.when(F.element_at(segs, -1).isin(".", ".."),
                      F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    joined = F.array_join(resolved, "/")
    return (F.when(joined == "", F.lit("/"))
            .when(~joined.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined))


def url_join(href, base) -> Column:
    """Resolve ``href`` against ``base`` like ``urllib.parse.urljoin``: absolute
    and ``//host`` links are kept as they are (scheme lower-cased), ``?q`` / ``#f``
    replace the base's query / fragment, ``/path`` and relative paths are merged with
    the base directory and their ``.`` / ``..`` segments resolved."""
    h = F.regexp_replace(col_of(href), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    b = _lit_or_col(base)
    b_scheme = F.lower(F.regexp_extract(b, _SCHEME, 1))
    b_origin = F.concat(b_scheme, F.lit("://"), F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    # ``;params`` of the last path segment stay out of dot-segment resolution
    b_path = F.regexp_replace(F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1),
                              r";[^/]*$", "")
    b_noq = F.regexp_replace(b, r"#.*$", "")
    h_full = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_path = F.regexp_replace(h_full, r";[^/]*$", "")
    h_rest = F.concat(F.regexp_extract(h_full, r"(;[^/]*)$", 1), F.regexp_extract(h, r"^[^?#]*(.*)$", 1))
    # relative path: base directory segments + the link's, empty middle segments dropped
    bp = F.split(b_path, "/")
    bp = F.when(F.element_at(bp, -1) != "", F.slice(bp, 1, F.size(bp) - 1)).otherwise(bp)
    rel = F.concat(bp, F.split(h_path, "/"))
    n = F.size(rel)
    rel = F.when(n > 2, F.concat(F.slice(rel, 1, 1), F.filter(F.slice(rel, 2, n - 2), lambda x: x != ""),
                                 F.slice(rel, -1, 1))).otherwise(rel)
    abs_scheme = F.lower(F.regexp_extract(h, _SCHEME, 1))
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(h.rlike(_SCHEME), F.concat(abs_scheme, F.lit("://"),
                                         F.regexp_replace(h, _SCHEME, "")))
        .when(h.rlike(_OPAQUE), h)
        .when(h.startswith("//"), F.concat(b_scheme, F.lit(":"), h))
        .when(h == "", b_noq)
        .when(h.startswith("?"), F.concat(F.regexp_replace(b, r"[?#].*$", ""), h))
        .when(h.startswith("#"), F.concat(b_noq, h))
        # the segment fold only runs for paths that need it (dot segments, or empty
        # segments inside a relative path)
        .when(h.startswith("/") & ~h_path.rlike(_DOTS), F.concat(b_origin, h_path, h_rest))
        .when(h.startswith("/"), F.concat(b_origin, _resolve_segments(F.split(h_path, "/")), h_rest))
        .when(~h_path.rlike(_DOTS) & ~b_path.rlike(_DOTS) & ~h_path.contains("//") & ~b_path.contains("//"),
              F.concat(b_origin, F.when(b_path == "", F.lit("/"))
                       .otherwise(F.regexp_replace(b_path, r"[^/]*$", "")), h_path, h_rest))
        .otherwise(F.concat(b_origin, _resolve_segments(rel), h_rest))
    )


def strip_url(u) -> Column:
    """Keep ``scheme://netloc/path``: drop query, fragment and ``;params`` of the
    last path segment. A link without an authority keeps its scheme: ``tel:1`` is
    ``tel://1``."""
    no_q = F.regexp_replace(F.regexp_replace(col_of(u), r"[?#].*$", ""),
                            r"^(?!(?i:https?):)([A-Za-z][A-Za-z0-9+.-]*):(?!//)", "$1://")
    # params live in the last path segment; a URL without a path has none (a ``;``
    # right after ``//host`` belongs to the host)
    has_path = no_q.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/")
    return F.when(has_path, F.regexp_replace(no_q, r";[^/]*$", "")).otherwise(no_q)


def normalize_url(href, base) -> Column:
    """``urljoin(base, href)`` reduced to ``scheme://netloc/path``."""
    return strip_url(url_join(href, base))


def prefix_url(href, base: str) -> Column:
    """Plain concatenation ``base + href`` (no resolution)."""
    return F.concat(F.lit(base), col_of(href))


def is_http_url(u) -> Column:
    """Text that starts with ``http://`` or ``https://`` (case-sensitive)."""
    return F.coalesce(col_of(u).rlike(r"^https?://"), F.lit(False))


def get_domain(u) -> Column:
    """C17: netloc of an http(s) URL with every ``www.`` removed; else NULL."""
    u = col_of(u)
    return F.when(is_http_url(u),
                  F.replace(F.regexp_extract(u, r"^https?://([^/?#]*)", 1),
                            F.lit("www."), F.lit("")))
