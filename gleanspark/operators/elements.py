"""Elements of an HTML fragment as one native expression.

``elements_sql`` gives every element that matches one selector step, in document order, as
``array<struct<tag, inner>>``: its opening tag and what it holds. The fragment is cut once at
the tags that matter for the step (its own name, and the names that end it), and one pass over
these tags with a stack of open elements pairs each opening tag with the tag that ends it. So
the work is linear in the tags, however they nest, and no text is copied but what is returned.

Three kinds of names end differently:

* most names end at their own close; inner elements of the name are stacked;
* ``li`` / ``dt`` / ``dd`` and ``td`` / ``th`` / ``tr`` may stay unclosed: they also end where
  the next item begins or their list or table closes. A list inside an item, or a table
  inside a cell, has items of its own: lists and tables are stacked as well;
* ``p`` ends where a block begins or an element around it closes.

A step without a tag name (``.price``) stacks all names: an element ends at its own close or
where one around it closes; ends that are implied by the next item need the name.

Selectors read attributes that are quoted, unquoted or bare; of a repeated attribute the
first counts. Expressions are built as SQL text: one parse instead of a call to the JVM per
node, and few levels of lambdas, each of which costs the analyzer a pass over the plan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions._util import col_of

# One piece of the inside of a tag: a quoted value, a bare word, a blank or an equals sign.
UNIT = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>\s=]++|[\s=])"""
_ATTR = r"""([^\s=>/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?"""

# Fixed values, as HTML defines them.
_P_ENDS = ("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
           "header hr main menu nav ol p pre section table ul").split()
_P_CLOSED_BY = "article aside blockquote body div dd dt footer form header li main nav section td th".split()
_LISTS, _TABLE = ("ul", "ol", "menu"), ("table",)
_PARTS = ("tbody", "thead", "tfoot")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


@dataclass(frozen=True)
class Scope:
    """How elements of a name end: where one of ``items`` opens, at any tag of ``ends`` or
    a close of ``items``, or where the scope, one of ``around``, closes."""
    items: tuple[str, ...]
    ends: tuple[str, ...]
    around: tuple[str, ...]


SCOPES = {
    "p": Scope(("p",), (), ()),                              # its other ends: ``_cuts``
    "li": Scope(("li",), (), _LISTS), "dt": Scope(("dt", "dd"), (), ("dl",)), "dd": Scope(("dt", "dd"), (), ("dl",)),
    "td": Scope(("td", "th"), ("tr", *_PARTS), _TABLE), "th": Scope(("td", "th"), ("tr", *_PARTS), _TABLE),
    "tr": Scope(("tr",), _PARTS, _TABLE),
}

#: Tags whose spans are collected before they are put to the others.
BLOCK = 256

_names = count()


def sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, body) -> str:
    """``body`` with ``value`` computed once and named."""
    v = f"v{next(_names)}"
    return f"element_at(transform(array({value}), {v} -> {body(v)}), 1)"


def apply_sql(c, body) -> Column:
    """The SQL expression ``body(name)`` on the Column ``c``."""
    v = f"v{next(_names)}"
    return F.element_at(F.call_function("transform", F.array(col_of(c)), F.expr(f"{v} -> {body(v)}")), 1)


# ---- attributes ------------------------------------------------------------

def attributes_sql(tag: str) -> str:
    names = f"transform(regexp_extract_all({tag}, {sql(_ATTR)}, 1), k -> lower(k))"
    values = f"regexp_extract_all({tag}, {sql(_ATTR)}, 2)"

    def entries(n: str, w: str) -> str:
        value = f"get({w}, i)"
        unquoted = f"IF({value} rlike '^[\"\\']', substring({value}, 2, length({value}) - 2), {value})"
        # the first match is the tag's own name behind its "<"
        return (f"map_from_entries(filter(transform({n}, (k, i) -> named_struct('k', k, 'v', {unquoted})), "
                f"(e, i) -> i > 0 AND array_position({n}, e.k) = i + 1))")

    return _let(names, lambda n: _let(values, lambda w: entries(n, w)))


def attributes(tag) -> Column:
    """``map<string,string>`` of an opening tag's attributes: names in lower case, values
    without quotes and with references as written; a bare name has ''."""
    return apply_sql(tag, attributes_sql)


def _char(c: str) -> str:
    """Regex of one character of a value, which a page may write as a reference."""
    refs = {"&": "&amp;|&", "<": "&lt;|<", ">": "&gt;|>", '"': '&quot;|"', "'": "&#39;|&apos;|'"}
    return f"(?:{refs[c]})" if c in refs else re.escape(c)


def _condition(name: str, value) -> str:
    """Look-ahead, behind the name of a tag, to the first attribute ``name``; ``value(inside)``
    is the regex of its value, given the class of the characters inside it."""
    n = rf"(?i:{re.escape(name)})"
    first = rf"(?:(?!\s{n}[\s=/>]){UNIT})*+\s{n}"
    if value is None:
        return rf"(?={first}[\s=/>])"
    return (rf"""(?={first}\s*+=\s*+(?:"{value('[^"]')}"|'{value("[^']")}'|"""
            rf"""(?!["']){value(r"[^\s>]")}(?=[\s>])))""")


def opening_regex(step) -> str:
    """The opening tag of an element that matches ``step``."""
    out = rf"<(?i:{step.tag or '[a-z][a-z0-9]*'})(?=[\s/>])"
    by_class = {c: "".join(map(_char, c)) for c in step.classes}
    for v in by_class.values():                              # one token of several
        out += _condition("class", lambda inside, v=v: rf"(?:{inside}*?\s)?{v}(?:\s{inside}*+)?")
    for name, op, value in step.attrs:
        v = "".join(map(_char, value or ""))
        out += _condition(name, None if op is None else (lambda inside, v=v: v) if op == "="
                          else (lambda inside, v=v: f"{inside}*?{v}{inside}*+"))
    return rf"{out}{UNIT}*+>"


# ---- places ----------------------------------------------------------------

def _cuts(step) -> str:
    """Regex of the places where the fragment is cut."""
    return rf"(?=(?i:{_names_of(step)})(?=[\s/>]))"


def _names_of(step) -> str:
    """Regex of the beginnings of the tags that matter for ``step``."""
    if step.tag is None:
        return "</?[a-z][a-z0-9]*"
    if step.tag == "p":
        return f"<(?:{'|'.join(_P_ENDS)})|</(?:p|{'|'.join(_P_CLOSED_BY)})"
    scope = SCOPES.get(step.tag)
    names = (*scope.items, *scope.ends, *scope.around) if scope else (step.tag,)
    return f"</?(?:{'|'.join(names)})"


def _tag_code(step) -> str:
    """What a tag ``s`` does: 1 opens a match, 3 another element of the kind, -1 closes one,
    0 ends an item, 2 and -2 open and close a scope."""
    match = f"s rlike {sql('(?s)^' + opening_regex(step))}"
    scope = SCOPES.get(step.tag)
    if not scope:
        return f"CASE WHEN s like '</%' THEN -1 WHEN {match} THEN 1 ELSE 3 END"

    def is_one(names, close: str = "") -> str:
        return f"s rlike {sql(f'(?i)^<{close}(?:{"|".join(names)})[^a-z0-9]')}" if names else "false"

    return (f"CASE WHEN {match} THEN 1 WHEN {is_one(scope.items)} THEN 3 WHEN {is_one(scope.around)} THEN 2 "
            f"WHEN {is_one(scope.around, '/')} THEN -2 ELSE 0 END")


def _spans(step, parts: str) -> str:
    """Sorted ``array<struct<i, z>>``: the part each match opens in and the one that ends it,
    0 if it never ends. The stack holds the part of a match, 0 for another element, -1 for a
    scope. Spans found are kept by blocks of tags, for an array that grows is copied."""
    top, rest = "element_at(a.st, -1)", "slice(a.st, 1, size(a.st) - 1)"
    done = f"IF({top} > 0, concat(a.out, array(named_struct('i', {top}, 'z', x.i))), a.out)"
    opened = "array(IF(x.c = 1, x.i, 0))"

    def state(st: str, out: str) -> str:
        return f"named_struct('st', {st}, 'out', {out}, 'done', a.done)"

    if step.tag is None:                                     # a close ends all that is open inside it
        depth = "array_position(reverse(transform(a.nm, y -> y)), x.n)"
        kept = f"size(a.st) - cast({depth} as int)"
        ended = (f"concat(a.out, transform(filter(slice(a.st, {kept} + 1, size(a.st)), y -> y > 0), "
                 "y -> named_struct('i', y, 'z', x.i)))")
        void = ", ".join(sql(v) for v in sorted(VOID))
        merge = (f"CASE WHEN x.c > 0 AND x.n IN ({void}) THEN "
                 "named_struct('st', a.st, 'out', IF(x.c = 1, concat(a.out, array(named_struct('i', x.i, 'z', x.i))), "
                 "a.out), 'done', a.done, 'nm', a.nm) "
                 f"WHEN x.c > 0 THEN named_struct('st', concat(a.st, {opened}), 'out', a.out, 'done', a.done, "
                 "'nm', concat(a.nm, array(x.n))) "
                 f"WHEN {depth} = 0 THEN a "
                 f"ELSE named_struct('st', slice(a.st, 1, {kept}), 'out', {ended}, 'done', a.done, "
                 f"'nm', slice(a.nm, 1, {kept})) END")
    elif step.tag in SCOPES:
        item = f"size(a.st) > 0 AND {top} >= 0"
        under = f"IF({item}, {rest}, a.st)"
        merge = (f"CASE WHEN x.c = 2 THEN {state('concat(a.st, array(-1))', 'a.out')} "
                 f"WHEN x.c > 0 THEN {state(f'concat({under}, {opened})', f'IF({item}, {done}, a.out)')} "
                 f"WHEN x.c = 0 THEN IF({item}, {state(rest, done)}, a) "
                 f"ELSE {state(f'slice({under}, 1, greatest(size({under}) - 1, 0))', f'IF({item}, {done}, a.out)')} END")
    else:
        merge = (f"CASE WHEN x.c > 0 THEN {state(f'concat(a.st, {opened})', 'a.out')} "
                 f"WHEN size(a.st) = 0 THEN a ELSE {state(rest, done)} END")

    name = r", 'n', lower(regexp_extract(s, '^</?([a-zA-Z0-9]+)', 1))" if step.tag is None else ""
    names, carried = (", 'nm', {nm}", ", 'nm', a.nm") if step.tag is None else ("", "")
    span = "array<struct<i:int,z:int>>"
    none = f"cast(array() as {span})"
    block = (f"aggregate(slice({{t}}, o + 1, {BLOCK}), named_struct('st', b.st, 'out', {none}, 'done', b.done"
             f"{names.format(nm='b.nm')}), (a, x) -> {merge}, "
             f"a -> named_struct('st', a.st, 'done', concat(a.done, array(a.out)){carried}))")
    start = (f"named_struct('st', cast(array() as array<int>), 'done', cast(array() as array<{span}>)"
             f"{names.format(nm='cast(array() as array<string>)')})")
    tags = f"transform(slice({parts}, 2, size({parts}) - 1), (s, j) -> named_struct('i', j + 2, 'c', {_tag_code(step)}{name}))"

    def folded(t: str) -> str:
        return (f"aggregate(sequence(0, size({t}) - 1, {BLOCK}), {start}, (b, o) -> {block.format(t=t)}, "
                "b -> sort_array(concat(flatten(b.done), transform(filter(b.st, y -> y > 0), "
                "y -> named_struct('i', y, 'z', 0)))))")

    return _let(tags, folded)


_EMPTY = "cast(array() as array<struct<tag:string,inner:string>>)"


def elements_sql(fragment: str, step, first: bool = False, outermost: bool = False, inner: bool = True,
                 card_end: str | None = None, cards: bool = False) -> str:
    """Elements of ``fragment`` that match ``step``. ``first``: only the first one.
    ``outermost``: none inside another. Without ``inner`` the insides are ''. ``cards``: one
    that never ends stops where the next one opens, the last one at ``card_end``."""
    opens, inner = opening_regex(step), inner and step.tag not in VOID
    opening = sql(f"(?s)^{opens}")
    if not inner and not outermost:                          # no ends needed
        tags = f"regexp_extract_all({fragment}, {sql(f'(?s){opens}')}, 0)"
        if first:
            tags = f"filter(array(regexp_extract({fragment}, {sql(f'(?s){opens}')}, 0)), t -> t <> '')"
        return f"transform({tags}, t -> named_struct('tag', t, 'inner', ''))"

    def found(p: str) -> str:
        spans = _spans(step, p)
        if outermost:
            spans = (f"aggregate({spans}, named_struct('u', 0, 'g', cast(array() as array<struct<i:int,z:int>>)), "
                     f"(a, s) -> IF(s.i < a.u, a, named_struct('u', IF(s.z = 0, size({p}) + 1, s.z), "
                     "'g', concat(a.g, array(s)))), a -> a.g)")
        if first:
            spans = f"slice({spans}, 1, 1)"
        if cards:
            return f"IF(size({p}) < 2, {_EMPTY}, {_let(spans, lambda sp: inside(p, sp, sp))})"
        return f"IF(size({p}) < 2, {_EMPTY}, {inside(p, spans, None)})"

    def inside(p: str, spans: str, named: str | None) -> str:
        tag = f"regexp_extract(element_at({p}, s.i), {opening}, 0)"
        last = f"coalesce(get({named}, j + 1).i, size({p}) + 1)" if named else f"size({p}) + 1"
        end = f"IF(s.z = 0, {last}, s.z)"
        text = (f"concat(substring(element_at({p}, s.i), length({tag}) + 1), "
                f"array_join(slice({p}, s.i + 1, greatest({end} - s.i - 1, 0)), ''))") if inner else "''"
        if card_end and named:
            text = (f"IF(s.z = 0 AND j + 1 = size({named}), "
                    f"regexp_replace({text}, {sql(f'(?is)(?:{card_end}).*$')}, ''), {text})")
        return f"transform({spans}, (s, j) -> named_struct('tag', {tag}, 'inner', {text}))"

    stacked = _let(f"split(concat(' ', {fragment}), {sql(_cuts(step))})", found)
    return _simple(fragment, step, opens, first, cards, stacked) if step.tag and inner else stacked


def _simple(fragment: str, step, opens: str, first: bool, cards: bool, stacked: str) -> str:
    """Elements that a regex delimits: where the next tag that matters ends each of them.
    ``stacked`` is for all other fragments."""
    around = SCOPES[step.tag].around if step.tag in SCOPES else (step.tag,)
    names = rf"(?i:{_names_of(step)})(?=[\s/>])"
    if first:
        nests = sql(rf"(?i)<(?:{'|'.join(around)})$") if around else sql("(?!)")
        found = f"regexp_extract({fragment}, {sql(f'(?s){opens}.*?{names}')}, 0)"

        def one(f: str) -> str:
            tag = f"regexp_extract({f}, {sql(f'(?s)^{opens}')}, 0)"
            inside = f"regexp_replace(substring({f}, length({tag}) + 1), '</?[a-zA-Z0-9]+$', '')"
            return (f"CASE WHEN {f} rlike {nests} OR ({f} = '' AND {fragment} rlike {sql(f'(?s){opens}')}) THEN {stacked} "
                    f"WHEN {f} = '' THEN {_EMPTY} ELSE array(named_struct('tag', {tag}, 'inner', {inside})) END")

        return _let(found, one)
    nests = f"rlike {sql(f'(?i)^<(?:{"|".join(around)})$')}" if around else "= 'none'"
    every = f"regexp_extract_all({fragment}, {sql(rf'(?s)({opens}.*?)(?={names}|\z)')}, 1)"
    after = f"regexp_extract_all({fragment}, {sql(rf'(?s){opens}.*?(?=({names})|\z)')}, 1)"
    tag = f"regexp_extract(t, {sql(f'(?s)^{opens}')}, 0)"
    if cards:                                                # one that never ends has ends of its own
        nests = f"{nests} OR y = ''"
    return (f"IF(exists({after}, y -> y {nests}), {stacked}, transform({every}, t -> "
            f"named_struct('tag', {tag}, 'inner', substring(t, length({tag}) + 1))))")


def select_sql(fragment: str, steps, first: bool = False, outermost: bool = False, inner: bool = True) -> str:
    """Elements of a descendant chain: the outermost elements of each step but the last are
    searched in turn, so that one ancestor gives each descendant once."""
    if len(steps) == 1:
        return elements_sql(fragment, steps[0], first=first, outermost=outermost, inner=inner)
    v = f"s{next(_names)}"
    scopes = elements_sql(fragment, steps[0], outermost=True)
    out = f"flatten(transform({scopes}, {v} -> {select_sql(f'{v}.inner', steps[1:], first, outermost, inner)}))"
    return f"slice({out}, 1, 1)" if first else out


def select(fragment, steps, first: bool = False, outermost: bool = False, inner: bool = True) -> Column:
    """``array<struct<tag, inner>>`` of the elements that match the chain ``steps``."""
    return apply_sql(fragment, lambda x: select_sql(x, steps, first, outermost, inner))
