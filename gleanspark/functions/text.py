"""Text column functions (C01, C12, C23, C27, C29, C30, C40) and HTML text helpers.

All functions take and return ``Column`` and run in the JVM (array functions such as ``let``
are evaluated outside whole-stage code).
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.functions._util import col_of, let

# Whitespace as Python's ``re`` and ``str.strip`` see it: Java's Unicode ``\s`` plus the
# four information separators U+001C..U+001F.
WS = r"(?U)[\s\x1c-\x1f]+"


def clean_text(c) -> Column:
    """Collapse every whitespace run to one space, strip both ends. NULL stays NULL.

    Collapse first: ``trim`` only removes spaces, so other whitespace must become a
    space before it.
    """
    return F.trim(F.regexp_replace(col_of(c), WS, " "))


def strip_text(c) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace, keep inner runs."""
    return F.regexp_replace(col_of(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def remove_chars(c, chars: str) -> Column:
    """Delete every character of ``chars``."""
    return F.translate(col_of(c), chars, "")


def extract_email(c) -> Column:
    """First ``[\\w.-]+@[\\w.-]+`` with Python's Unicode ``\\w`` (letters, numbers,
    underscore -- not the combining marks Java's ``(?U)\\w`` adds), NULL when none. The
    regex only runs on texts that contain an ``@`` (a cheap search first)."""
    c = col_of(c)
    return F.when(c.contains("@"),
                  F.nullif(F.regexp_extract(c, r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+", 0), F.lit("")))


def is_nonempty(c) -> Column:
    """C30 ``is_nonempty_str``: not NULL and not blank. Never NULL itself."""
    return F.coalesce(F.length(strip_text(c)) > 0, F.lit(False))


def safe_lower(c) -> Column:
    """C30 ``safe_lower``: lower case, NULL -> ''."""
    return F.coalesce(F.lower(col_of(c)), F.lit(""))


def nonempty_or_null(c) -> Column:
    """'' -> NULL (the "truthy" test of C24)."""
    c = col_of(c)
    return F.when(c != "", c)


def first_truthy(*cols) -> Column:
    """First value that is neither NULL nor ''."""
    return F.coalesce(*[nonempty_or_null(c) for c in cols])


def clean_all_text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Apply C01 to every string column in one projection."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and f.name not in exclude:
            out.append(clean_text(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# Named character references, from the standard library's table: a literal map that is
# folded to a constant when the plan is made. A few old names also count without ";".
_NAMED = json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")}, ensure_ascii=True)
_BARE = "|".join(sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True))


def _sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _decoder() -> str:
    """The decoder as one SQL lambda: a text is cut at ``&``, numbers are decoded as UTF-32
    (128-159 by the Windows code page they mean) and names are looked up."""
    page = [c for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    src, dst = "".join(map(chr, page)), bytes(page).decode("cp1252")
    number = _sql("^#([0-9]+|[xX][0-9a-fA-F]+);?")
    digits = f"regexp_extract(p, {number}, 1)"
    value = (f"coalesce(try_cast(CASE WHEN {digits} rlike '^[xX]' THEN conv(substring({digits}, 2), 16, 10) "
             f"ELSE {digits} END AS decimal(38,0)), 1114112)")
    char = (f"CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN '\ufffd' "
            "WHEN n BETWEEN 1 AND 8 OR n BETWEEN 14 AND 31 OR n IN (11, 127) OR n BETWEEN 64976 AND 65007 "
            "OR n % 65536 >= 65534 THEN '' "
            f"ELSE translate(decode(unhex(lpad(hex(CAST(n AS bigint)), 8, '0')), 'UTF-32'), {_sql(src)}, {_sql(dst)}) END")
    numeric = (f"concat(element_at(transform(array({value}), n -> {char}), 1), "
               f"substring(p, length(regexp_extract(p, {number}, 0)) + 1))")
    names = f"from_json({_sql(_NAMED)}, 'map<string,string>')"
    full = f"regexp_extract(p, {_sql('^([A-Za-z][A-Za-z0-9]{0,31});')}, 1)"
    bare = f"regexp_extract(p, {_sql(f'^(?:{_BARE})')}, 0)"
    named = (f"CASE WHEN {full} <> '' AND map_contains_key({names}, {full}) "
             f"THEN concat(element_at({names}, {full}), substring(p, length({full}) + 2)) "
             f"WHEN {bare} <> '' THEN concat(element_at({names}, {bare}), substring(p, length({bare}) + 1)) "
             "ELSE concat('&', p) END")
    part = f"CASE WHEN p rlike '^#([0-9]|[xX][0-9a-fA-F])' THEN {numeric} ELSE {named} END"
    rest = "slice(split(x, '&'), 2, greatest(size(split(x, '&')) - 1, 0))"
    return (f"x -> CASE WHEN contains(x, '&') THEN concat(element_at(split(x, '&'), 1), "
            f"array_join(transform({rest}, p -> {part}), '')) ELSE x END")


_DECODER = _decoder()


def html_unescape(c) -> Column:
    """Decode character references like ``html.unescape`` (NULL stays NULL). Deterministic, so
    filters written after it still reach the scan. Texts without ``&`` are not touched."""
    return F.element_at(F.call_function("transform", F.array(col_of(c)), F.expr(_DECODER)), 1)


# A tag; a ``>`` inside a quoted value does not end it.
TAG = r"""<(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+>"""
_TAG = "\u0000"   # stands for a removed tag between two text nodes


def html_text(fragment, mode: str = "clean") -> Column:
    """Text of an HTML fragment (tags removed, entities decoded).

    Modes, matching the four text reads of the captured pipelines:
    ``raw``   every text node concatenated as is;
    ``strip`` the same, stripped at both ends;
    ``tight`` every text node stripped, empty ones dropped, joined with '';
    ``space`` every text node stripped, empty ones dropped, joined with ' ';
    ``clean`` ``space`` followed by C01 (rendered-text reads).
    """
    frag = col_of(fragment)
    if mode == "raw":
        return html_unescape(F.regexp_replace(frag, TAG, ""))
    if mode == "strip":
        return strip_text(html_unescape(F.regexp_replace(frag, TAG, "")))
    if mode in ("tight", "space"):
        # every tag becomes a sentinel and references are decoded, then a whitespace /
        # sentinel run becomes the joiner, so a text node is stripped of what its
        # references stand for. Only character-class runs: Java matches those
        # iteratively, while a repeated variable-width group recurses per repetition
        # and overflows the stack on long runs of tags.
        marked = html_unescape(F.regexp_replace(frag, TAG, _TAG))
        joined = F.regexp_replace(marked, rf"(?U)[\s\x1c-\x1f]*{_TAG}[\s\x1c-\x1f{_TAG}]*",
                                  "" if mode == "tight" else " ")
        return strip_text(joined)
    if mode == "clean":
        return clean_text(html_unescape(F.regexp_replace(frag, TAG, " ")))
    raise ValueError(f"unknown text mode {mode!r}")


def strip_noise(html) -> Column:
    """Remove comments, ``<script>`` and ``<style>`` blocks before any element search
    (a ``</p>`` inside a script string must not close a paragraph)."""
    return F.regexp_replace(
        col_of(html), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
