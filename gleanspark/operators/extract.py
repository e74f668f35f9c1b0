"""Spec-driven record extraction from captured HTML.

An ``ExtractSpec`` names a card selector and field selectors; ``extract`` compiles
every selector to native expressions (``elements``) and runs the whole extraction with them:

    pages --strip_noise--> elements of the card selector --fields of each--> inline to rows

No Python runs per row, the wide ``html`` column is projected away inside the same
stage (no shuffle carries it), and the work is per page, so it scales with the
number of input partitions.

Selector subset: ``tag``, ``.class`` (several), ``[attr]``, ``[attr="v"]``,
``[attr*="v"]``, descendant (space). Elements are found by their opening tag, whose
attributes may be quoted, unquoted or bare, and end where HTML ends them: at their own
close, or, for list items, table cells and rows and paragraphs, where that is implied. A list
inside an item, or a table inside a cell, belongs to it. A card is its element, inner cards
included; a card that is never closed ends at the next one, the last one at ``card_end``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions._util import let
from gleanspark.functions.text import html_text, html_unescape, strip_noise
from gleanspark.operators.elements import apply_sql, attributes, elements_sql, select, select_sql

_STEP = re.compile(
    r"""^(?P<tag>[a-zA-Z][a-zA-Z0-9]*|\*)?(?P<rest>(?:\.[\w-]+|\[[^\]]+\])*)$""")
_PART = re.compile(r"""\.([\w-]+)|\[([\w-]+)(?:(\*?=)"([^"]*)")?\]""")


@dataclass(frozen=True)
class Step:
    tag: str | None
    classes: tuple[str, ...]
    attrs: tuple[tuple[str, str | None, str | None], ...]   # (name, op, value)


def parse_selector(sel: str) -> tuple[Step, ...]:
    steps = []
    for tok in sel.split():
        m = _STEP.match(tok)
        if not m:
            raise ValueError(f"unsupported selector step {tok!r} in {sel!r}")
        classes, attrs = [], []
        for pm in _PART.finditer(m.group("rest") or ""):
            if pm.group(1):
                classes.append(pm.group(1))
            else:
                attrs.append((pm.group(2), pm.group(3), pm.group(4)))
        tag = m.group("tag")
        steps.append(Step(None if tag in (None, "*") else tag.lower(), tuple(classes), tuple(attrs)))
    return tuple(steps)


@dataclass(frozen=True)
class Field:
    """One output column.

    ``selector``: a selector, or a tuple of them tried in order (B05, first non-empty
    wins); ``None`` means the card (or page) itself.
    ``attr``: read this attribute instead of the text.
    ``mode``: text mode of :func:`html_text` (``raw``/``strip``/``tight``/``space``/``clean``).
    ``many``: every match, as ``array<string>`` of non-empty values (B04).
    ``has``: keep only matches that contain an element matching each of these
    selectors, then read ``then`` inside the first kept one (B08).
    ``post``: a Column -> Column function applied last (type casts, C-functions).
    """
    name: str
    selector: str | tuple[str, ...] | None
    attr: str | None = None
    mode: str = "clean"
    many: bool = False
    has: tuple[str, ...] = ()
    then: str | None = None
    post: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class ExtractSpec:
    name: str
    card: str | None
    fields: tuple[Field, ...]
    required: tuple[str, ...] = ()
    card_end: str | None = None
    strip_noise: bool = True
    extra: dict = field(default_factory=dict, compare=False, hash=False)


def _nonempty(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def _value(element: Column, f: Field) -> Column:
    """What ``f`` reads of one element; '' if there is nothing."""
    if f.attr:
        return html_unescape(F.coalesce(F.element_at(attributes(element["tag"]), f.attr.lower()), F.lit("")))
    return html_text(element["inner"], f.mode)


def _read_one(frag: Column, sel: str | None, f: Field, tag: Column | None = None) -> Column:
    if sel is None:                                          # the card or page itself
        if f.attr:
            own = F.lit("") if tag is None else tag
            return _nonempty(_value(F.struct(own.alias("tag")), f))
        return _nonempty(html_text(frag, f.mode))
    found = select(frag, parse_selector(sel), first=True, inner=f.attr is None)
    return let(F.get(found, F.lit(0)), lambda e: _nonempty(_value(e, f)))


def _read_many(frag: Column, sel: str, f: Field) -> Column:
    found = select(frag, parse_selector(sel), inner=f.attr is None)
    return F.filter(F.transform(found, lambda e: _value(e, f)), lambda x: x != "")


def _read_has(frag: Column, f: Field) -> Column:
    blocks = F.transform(select(frag, parse_selector(f.selector)), lambda e: e["inner"])
    for h in f.has:
        steps = parse_selector(h)
        blocks = F.filter(blocks, lambda b: F.size(select(b, steps, first=True, inner=False)) > 0)
    first = F.get(blocks, F.lit(0))
    sub = Field(f.name, f.then, attr=f.attr, mode=f.mode)
    return _read_one(first, f.then, sub) if f.then else _nonempty(html_text(first, f.mode))


def field_column(frag: Column, f: Field, tag: Column | None = None) -> Column:
    """The Column for one field, evaluated on an HTML fragment: a page, or the inside of a
    card whose opening tag is ``tag``."""
    if f.has:
        out = _read_has(frag, f)
    elif f.many:
        out = _read_many(frag, f.selector, f)
    elif isinstance(f.selector, tuple):
        out = F.coalesce(*[_read_one(frag, s, f) for s in f.selector])
    else:
        out = _read_one(frag, f.selector, f, tag)
    return f.post(out) if f.post else out


def split_cards(html: Column, card: str, card_end: str | None = None) -> Column:
    """``array<struct<tag, inner>>`` of the cards in document order. With a descendant
    selector (``nav li``) cards are taken only inside the ancestor elements."""
    *scopes, step = parse_selector(card)

    def cards(x: str) -> str:
        return elements_sql(x, step, card_end=card_end, cards=True)

    if scopes:
        return apply_sql(html, lambda x: f"flatten(transform({select_sql(x, scopes, outermost=True)}, "
                                         f"a -> {cards('a.inner')}))")
    return apply_sql(html, cards)


def _required_ok(rec: Column, required: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for r in required:
        v = rec[r]
        ok = ok & v.isNotNull() & (v.cast("string") != "")
    return ok


def extract(pages: DataFrame, spec: ExtractSpec, html_col: str = "html",
            keep: tuple[str, ...] | None = None) -> DataFrame:
    """Run ``spec`` over a pages table.

    With a card selector: one row per card, ``pos`` = 0-based card ordinal in the
    page (G01). Without: one row per page (B23). ``keep`` columns (default: all but
    the html) are carried through (A09). Rows missing a ``required`` field are
    dropped (D01, B21).

    Each card becomes one struct of its fields inside the page row (``transform``),
    the required check filters that array and ``inline`` makes the rows. Every field
    regex therefore runs once per card; a row filter written after a projection
    would be pushed below it with the field expressions copied into it, running
    every regex twice.
    """
    keep = tuple(c for c in pages.columns if c != html_col) if keep is None else keep
    html = F.col(html_col)
    if spec.strip_noise:
        html = strip_noise(html)

    if spec.card:
        recs = F.transform(split_cards(html, spec.card, spec.card_end), lambda c, i: F.struct(
            i.alias("pos"), *[field_column(c["inner"], f, c["tag"]).alias(f.name) for f in spec.fields]))
    else:
        recs = F.array(F.struct(*[field_column(html, f).alias(f.name) for f in spec.fields]))
    if spec.required:
        recs = F.filter(recs, lambda r: _required_ok(r, spec.required))
    return pages.select(*keep, F.inline(recs))


def extract_lists(pages: DataFrame, spec: ExtractSpec, html_col: str = "html",
                  keep: tuple[str, ...] | None = None, strict: bool = True) -> DataFrame:
    """Page-wide parallel lists (one per field, every match) zipped by position.

    ``strict`` fails the job when the lists of a page differ in length, as zipping
    unequal lists is an error; otherwise short lists are padded with NULL.
    """
    base, differ = _lists(pages, spec, html_col, keep)
    if strict:
        base = base.withColumn("_chk", F.when(~differ, F.lit(True)).otherwise(
            F.raise_error(F.lit("parallel lists differ in length")))).filter("_chk").drop("_chk")
    return _zipped(base, spec, F.posexplode)


def extract_lists_checked(pages: DataFrame, spec: ExtractSpec, html_col: str = "html",
                          keep: tuple[str, ...] | None = None) -> DataFrame:
    """B06 without the stop: a page whose lists differ in length is one row without fields,
    and its ``reason`` names their lengths; the rows of other pages have none."""
    base, differ = _lists(pages, spec, html_col, keep)
    lengths = F.concat_ws(", ", *[F.concat(F.lit(f"{f.name} "), F.size(f.name).cast("string")) for f in spec.fields])
    base = base.withColumn("reason", F.when(differ, F.concat(F.lit("lists differ in length: "), lengths)))
    out = _zipped(base, spec, F.posexplode_outer, carry=("reason",))
    return out.filter(F.col("pos").isNotNull() | F.col("reason").isNotNull())


def _lists(pages: DataFrame, spec: ExtractSpec, html_col: str, keep) -> tuple[DataFrame, Column]:
    keep = tuple(c for c in pages.columns if c != html_col) if keep is None else keep
    html = strip_noise(F.col(html_col)) if spec.strip_noise else F.col(html_col)
    lists = [_read_many(html, f.selector, f).alias(f.name) for f in spec.fields]
    sizes = [F.size(f.name) for f in spec.fields]
    differ = F.lit(False)
    for s in sizes[1:]:
        differ = differ | (s != sizes[0])
    return pages.select(*keep, *lists), differ


def _zipped(base: DataFrame, spec: ExtractSpec, explode: Callable, carry: tuple[str, ...] = ()) -> DataFrame:
    names = [f.name for f in spec.fields]
    keep = [c for c in base.columns if c not in names and c not in carry]
    zipped = F.arrays_zip(*names)
    for c in carry:                                          # a page with a reason has no rows
        zipped = F.when(F.col(c).isNull(), zipped)
    exploded = base.select(*keep, *carry, explode(zipped).alias("pos", "_z"))
    cols = []
    for f in spec.fields:
        c = F.col("_z")[f.name]
        cols.append((f.post(c) if f.post else c).alias(f.name))
    return exploded.select(*keep, "pos", *cols, *carry)
