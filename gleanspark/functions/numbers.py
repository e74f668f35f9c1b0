"""Number, price and money parsing as native column expressions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.functions._util import col_of
from gleanspark.functions.text import clean_text

# Currency marks removed before parsing a price.
TAKA_SIGN = "৳"
TK_MARKERS = ["TK.", "Tk.", "TK"]

# Digits as Python's ``re`` (``\d``) and ``int()`` / ``float()`` read them: any Unicode
# decimal digit. Java matches them with ``(?U)\d``; ``translate`` maps them to ASCII
# before the cast. The table is built from the Unicode database by rule.
FIRST_NUMBER = r"(?U)\d+(\.\d+)?"


@functools.lru_cache(maxsize=1)
def _digit_table() -> tuple[str, str]:
    src, dst = [], []
    for cp in range(0x20000):          # every decimal digit lies in the first two planes
        ch = chr(cp)
        if not ("0" <= ch <= "9") and unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


def ascii_digits(c) -> Column:
    """Every Unicode decimal digit to its ASCII digit (``'১২'`` -> ``'12'``)."""
    src, dst = _digit_table()
    return F.translate(col_of(c), src, dst)


# A whole number text; Java's own type suffixes (12d, 12f) are none.
_NUMBER = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)$"


def _to_double(txt: Column) -> Column:
    """A number text as double, anything else (also NaN) NULL."""
    return F.when(txt.rlike(_NUMBER), txt.try_cast(T.DoubleType()))


def _strict(txt: Column, to: str) -> Column:
    """Cast that fails the job on bad text, whatever the session's ANSI setting."""
    value = txt.try_cast(to)
    bad = txt.isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"not a {to}: "), txt)).cast(to)).otherwise(value)


def price_strict(c, remove: str = TAKA_SIGN + ",") -> Column:
    """Drop the marks, strip; the whole text must be a number, else NULL."""
    txt = F.trim(F.regexp_replace(F.translate(col_of(c), remove, ""), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return _to_double(ascii_digits(txt))


def price_first(c, remove: str = TAKA_SIGN + ",") -> Column:
    """Drop the marks, take the first ``\\d+(\\.\\d+)?``."""
    return ascii_digits(F.regexp_substr(F.translate(col_of(c), remove, ""), F.lit(FIRST_NUMBER))) \
        .try_cast(T.DoubleType())


def price_marker(c, markers=TK_MARKERS) -> Column:
    """Remove the ``TK`` markers (in order) and commas, then the first number."""
    out = col_of(c)
    for m in markers:
        out = F.replace(out, F.lit(m), F.lit(""))
    out = F.replace(out, F.lit(","), F.lit(""))
    return ascii_digits(F.regexp_substr(out, F.lit(FIRST_NUMBER))).try_cast(T.DoubleType())


def clean_int(c) -> Column:
    """First ``\\d[\\d,]*`` with commas removed, as bigint; NULL when none."""
    digits = F.regexp_substr(col_of(c), F.lit(r"(?U)\d[\d,]*"))
    return ascii_digits(F.replace(digits, F.lit(","), F.lit(""))).try_cast(T.LongType())


def clean_float(c) -> Column:
    """First ``\\d+(\\.\\d+)?`` as double (a sign is lost, commas end the number)."""
    return ascii_digits(F.regexp_substr(col_of(c), F.lit(FIRST_NUMBER))).try_cast(T.DoubleType())


def zero_if_empty(c, to: str = "int") -> Column:
    """``int(x or 0)`` -- blank is 0, anything else must parse (strict)."""
    txt = F.coalesce(F.nullif(F.trim(col_of(c)), F.lit("")), F.lit("0"))
    return _strict(txt, to)


def strict_cast(c, to: str) -> Column:
    """Bad text fails the job; NULL stays NULL."""
    return _strict(F.trim(col_of(c)), to)


def coerce_double(c) -> Column:
    """C11: ``pd.to_numeric(errors='coerce')``: bad -> NULL (never NaN)."""
    return _to_double(F.trim(col_of(c).cast("string")))


def map_lookup(c, mapping: dict, strict: bool = False) -> Column:
    """Dictionary lookup from a literal map.

    ``strict`` raises on a key that is not in the map (C13); otherwise NULL (C14).
    """
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    val = F.try_element_at(m, col_of(c))
    if strict:
        return F.when(val.isNull(), F.raise_error(F.concat(
            F.lit("unknown key: "), F.coalesce(col_of(c).cast("string"), F.lit("NULL")))))\
            .otherwise(val)
    return val


MONEY_SCHEMA = T.StructType([
    T.StructField("currencyCode", T.StringType()),
    T.StructField("units", T.StringType()),
    T.StructField("nanos", T.StringType()),
])


def money_to_text(m) -> Column:
    """``{currencyCode, units, nanos}`` -> ``'<currency> <units + nanos/1e9>'`` at 2 dp.

    Unparseable units or nanos count as 0; a NULL or empty object (no field set) gives
    NULL. The sum is exact
    (decimal) and rounded half-to-even, so 2.125 -> '2.12'.
    """
    m = col_of(m)
    units = F.coalesce(F.trim(m["units"]).try_cast(T.LongType()), F.lit(0)).cast("decimal(38,9)")
    nanos = F.coalesce(F.trim(m["nanos"]).try_cast(T.LongType()), F.lit(0)).cast("decimal(38,9)")
    value = F.bround(units + nanos / F.lit(1_000_000_000).cast("decimal(38,9)"), 2)
    txt = F.format_number(value, 2)
    txt = F.replace(txt, F.lit(","), F.lit(""))
    cur = m["currencyCode"]
    out = F.when((cur.isNotNull()) & (cur != ""), F.concat(cur, F.lit(" "), txt)).otherwise(txt)
    return F.when(F.coalesce(cur, m["units"], m["nanos"]).isNotNull(), out)


def price_range_text(r) -> Column:
    """``{startPrice, endPrice}`` -> struct(start, end) of money texts."""
    r = col_of(r)
    return F.struct(money_to_text(r["startPrice"]).alias("start"),
                    money_to_text(r["endPrice"]).alias("end"))


# The TK price pattern of the bookstore price block.
TK_PRICE = r"(?iU)TK\.?\s*[\d,]+"


def price_block(block_text, strike_text) -> Column:
    """B15 + B20: (current, old) price texts from a price block.

    ``P`` = every ``TK`` price in the block text, ``old`` = the struck-through text.
    One price: current = P[0] unless an old price exists. Two or more: current =
    P[-1] and old = old or P[0]. None: (NULL, old).
    """
    txt = clean_text(block_text)
    old = F.nullif(clean_text(strike_text), F.lit(""))
    p = F.regexp_extract_all(txt, F.lit(TK_PRICE), 0)
    n = F.size(p)
    current = (F.when(n == 1, F.when(old.isNull(), p[0]))
               .when(n >= 2, F.element_at(p, -1)))
    old_out = F.when(n >= 2, F.coalesce(old, p[0])).otherwise(old)
    return F.struct(current.alias("current"), old_out.alias("old"))


def bracket_count(text) -> Column:
    """First ``(<digits>)`` in the text as bigint."""
    return ascii_digits(F.nullif(F.regexp_extract(col_of(text), r"(?U)\((\d+)\)", 1), F.lit(""))) \
        .try_cast(T.LongType())


def swap_if_no_discount(current, old) -> Column:
    """Current empty and old present -> current = old, old = NULL."""
    cur, od = col_of(current), col_of(old)
    no_cur = cur.isNull() | (cur == "")
    has_old = od.isNotNull() & (od != "")
    return F.struct(F.when(no_cur & has_old, od).otherwise(cur).alias("current"),
                    F.when(no_cur & has_old, F.lit(None).cast("string")).otherwise(od).alias("old"))


def null_if_missing(c) -> Column:
    """NaN and the texts a missing value leaves behind become NULL."""
    c = col_of(c)
    return F.when(~F.trim(c.cast("string")).isin("", "nan", "NaN", "None", "<NA>"), c)
