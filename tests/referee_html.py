"""Referee of the native extraction (L04): the same ``ExtractSpec`` run by ``mapInPandas``
with the standard library's ``html.parser``.

Spark partitions the pages and streams Arrow batches to the Python workers; each
page is parsed into a light element tree once, selectors are matched on the tree,
and only the extracted strings come back. ``post`` functions of the spec are Column
functions and run natively after the batch step. Output rows and columns equal
``extract`` on pages both paths can read (checked in the tests).
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.operators.extract import ExtractSpec, Field, Step, parse_selector

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_SKIP = {"script", "style"}
_BLOCK = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table", "article",
          "section", "footer", "nav", "header", "aside", "form", "pre", "blockquote", "hr", "dl",
          "main", "menu", "address", "details", "fieldset", "figure", "figcaption"}
_CLOSES = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"},
           "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
# an item is not closed from inside a list or table of its own
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"},
          "td": {"table"}, "th": {"table"}, "tr": {"table"}}
_WS = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def _walk(self):
        """Descendants (elements and strings) in document order, without recursion
        (deeply nested pages must not hit the interpreter's recursion limit)."""
        stack = list(reversed(self.children))
        while stack:
            c = stack.pop()
            yield c
            if isinstance(c, Node):
                stack.extend(reversed(c.children))

    def iter(self):
        return (c for c in self._walk() if isinstance(c, Node))

    def strings(self):
        return (c for c in self._walk() if not isinstance(c, Node))


def _first(attrs):
    """Of a repeated attribute the first counts."""
    return {k: (v or "") for k, v in reversed(attrs)}


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.cur = self.root
        self.skip = 0

    def _close(self, tags):
        n = self.cur
        while n is not self.root and n.tag not in tags:
            n = n.parent
        if n is not self.root:
            self.cur = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip += 1
            return
        if tag in _BLOCK and self._open("p"):
            self._close({"p"})
        if tag in _CLOSES and self._open(*_CLOSES[tag], within=_SCOPE[tag]):
            self._close(_CLOSES[tag])
        node = Node(tag, _first(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        if tag not in _SKIP:
            self.cur.children.append(Node(tag, _first(attrs), self.cur))

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
            return
        if self._open(tag, within=_SCOPE.get(tag, ())):
            self._close({tag})

    def handle_data(self, data):
        if not self.skip:
            self.cur.children.append(data)

    def _open(self, *tags, within=()):
        n = self.cur
        while n is not self.root and n.tag not in within:
            if n.tag in tags:
                return True
            n = n.parent
        return False


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _match(node: Node, st: Step) -> bool:
    if st.tag and node.tag != st.tag:
        return False
    if st.classes:
        have = set(node.attrs.get("class", "").split())
        if not set(st.classes) <= have:
            return False
    for name, op, val in st.attrs:
        if name not in node.attrs:
            return False
        if op == "=" and node.attrs[name] != val:
            return False
        if op == "*=" and val not in node.attrs[name]:
            return False
    return True


def select(scope: Node, steps: tuple[Step, ...]) -> list[Node]:
    """Every element under ``scope`` matching the descendant chain, in document order."""
    out = []
    for n in scope.iter():
        if not _match(n, steps[-1]):
            continue
        i, a = len(steps) - 2, n.parent
        while i >= 0 and a is not None and a is not scope.parent:
            if _match(a, steps[i]):
                i -= 1
            a = a.parent
        if i < 0:
            out.append(n)
    return out


def text(node: Node, mode: str) -> str:
    parts = list(node.strings())
    if mode == "raw":
        return "".join(parts)
    if mode == "strip":
        return "".join(parts).strip()
    stripped = [p.strip() for p in parts if p.strip()]
    if mode == "tight":
        return "".join(stripped)
    if mode == "space":
        return " ".join(stripped)
    return _WS.sub(" ", " ".join(parts)).strip()     # clean


def _nonempty(s):
    return s if s else None


def _read(node: Node, sel, f: Field):
    if f.has:
        blocks = select(node, parse_selector(f.selector))
        for h in f.has:
            hs = parse_selector(h)
            blocks = [b for b in blocks if select(b, hs)]
        if not blocks:
            return None
        sub = Field(f.name, f.then, attr=f.attr, mode=f.mode)
        return _read(blocks[0], f.then, sub) if f.then else _nonempty(text(blocks[0], f.mode))
    if f.many:
        found = select(node, parse_selector(sel))
        vals = [(n.attrs.get(f.attr, "") if f.attr else text(n, f.mode)) for n in found]
        return [v for v in vals if v != ""]
    if isinstance(sel, tuple):
        for s in sel:
            v = _read(node, s, Field(f.name, s, attr=f.attr, mode=f.mode))
            if v is not None:
                return v
        return None
    if sel is None:
        return _nonempty(node.attrs.get(f.attr, "") if f.attr else text(node, f.mode))
    found = select(node, parse_selector(sel))
    if not found:
        return None
    n = found[0]
    return _nonempty(n.attrs.get(f.attr, "") if f.attr else text(n, f.mode))


def _records(html: str, spec: ExtractSpec):
    root = parse(html)
    if spec.card:
        cards = select(root, parse_selector(spec.card))
        for pos, c in enumerate(cards):
            yield pos, {f.name: _read(c, f.selector, f) for f in spec.fields}
    else:
        yield None, {f.name: _read(root, f.selector, f) for f in spec.fields}


def extract_py(pages: DataFrame, spec: ExtractSpec, html_col: str = "html",
               keep: tuple[str, ...] | None = None) -> DataFrame:
    """``extract`` through ``mapInPandas`` (same output schema and rows)."""
    keep = tuple(c for c in pages.columns if c != html_col) if keep is None else keep
    fields = [T.StructField(f.name, T.ArrayType(T.StringType()) if f.many else T.StringType())
              for f in spec.fields]
    lead = [pages.schema[c] for c in keep]
    pos = [T.StructField("pos", T.IntegerType())] if spec.card else []
    schema = T.StructType(lead + pos + fields)
    required = spec.required

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                d = row._asdict()
                for p, rec in _records(d[html_col], spec):
                    if any(rec[r] in (None, "") for r in required):
                        continue
                    r = {c: d[c] for c in keep}
                    if spec.card:
                        r["pos"] = p
                    r.update(rec)
                    out.append(r)
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    res = pages.select(*keep, html_col).mapInPandas(run, schema)
    posts = [(f.name, f.post) for f in spec.fields if f.post]
    for name, fn in posts:
        res = res.withColumn(name, fn(F.col(name)))
    return res
