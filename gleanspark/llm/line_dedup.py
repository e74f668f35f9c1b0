"""Removal of repeated passages by content-defined line chunks (operator 2).

Every line is hashed; a rolling hash over the hashes of the last ``window`` lines closes a
chunk wherever it is 0 modulo ``divisor``. Boundaries depend on nearby lines only, so the
same passage is cut alike wherever it stands and inserted lines move no other boundary.
Chunks of two or more lines that occur more than once in the corpus are removed, all but
the first occurrence (smallest id, then place), once their bytes are seen to be equal.

A shared passage rarely begins and ends at a chunk border, and one long line is no chunk of
two. With ``passage_words``, the shortest runs of lines over so many words, from each line on
and up to each line, are pieces beside the chunks. Which lines such a run holds depends on
these lines alone, and the runs inside a passage cover it: every repeated run of lines over
``passage_words`` words goes whole, one-line passages too.

Hashes travel without text: one narrow row per piece, counted by a partial aggregate, so a
piece that a third of all documents share is one row per input partition. Only then are
bytes compared, for repeated pieces alone. The whole text is shuffled once, by id, and both
its readers use that exchange.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import bounded_batches, materialize

_COUNTS = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15                       # any odd multiplier


def chunks(text: str, window: int = 2, divisor: int = 2) -> list[tuple[int, int, int]]:
    """(start, end, lines) of each chunk, in characters; the newline between two chunks
    belongs to neither."""
    out, at, start, lines, roll, recent = [], 0, 0, 0, 0, []
    drop = pow(_BASE, window, 1 << 64)
    for line in text.split("\n"):
        h = xxhash.xxh3_64_intdigest(line)
        recent.append(h)
        roll = (roll * _BASE + h) & _MASK        # polynomial over the last `window` hashes
        if len(recent) > window:
            roll = (roll - recent.pop(0) * drop) & _MASK
        at += len(line) + 1
        lines += 1
        if (roll ^ (roll >> 31)) % divisor == 0:
            out.append((start, at - 1, lines))
            start, lines = at, 0
    if lines:
        out.append((start, at - 1, lines))
    return out


def passages(text: str, words: int) -> set[tuple[int, int]]:
    """(start, end), in characters, of the shortest runs of lines with over ``words`` words
    that begin at a line with words or end at one; blank lines never begin or end a run.
    A line that is a run alone also makes one with the next over the blank lines between."""
    lines = text.split("\n")
    counts = [len(line.encode("utf-8", "surrogatepass").split()) for line in lines]
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line) + 1)
    runs, first, total, before = set(), 0, 0, -1     # before: the last line with words
    for last, n in enumerate(counts):
        if not n:
            continue
        if 0 <= before < last - 1 and counts[before] > words:
            runs.add((before, last))
        before = last
        total += n
        while total > words:                         # the shortest run from each line on
            if counts[first]:
                runs.add((first, last))
            total -= counts[first]
            first += 1
        back, at = total, first                      # and the shortest up to `last`
        while at and back <= words:
            at -= 1
            back += counts[at]
        if back > words:
            runs.add((at, last))
    return {(starts[i], starts[j + 1] - 1) for i, j in runs}


def pieces(text: str, spans: list[tuple[int, int, int]], words: int | None) -> set[tuple[int, int]]:
    """(start, end) of what may go: chunks of two or more lines, and passages."""
    return {s[:2] for s in spans if s[2] > 1} | (passages(text, words) if words is not None else set())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digest(piece: str) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(piece)
    return _signed(d >> 64), _signed(d & _MASK)


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2,
               divisor: int = 2, keep: bool = False, passage_words: int | None = None) -> DataFrame:
    """``id_col, text, n_lines, n_chunks, n_removed_chunks, n_removed_lines`` of every row
    (with ``keep``, all columns of ``df`` as well; a column of one of these counts' names is
    replaced).

    ``text`` is what stays, under the name ``text_col``; lines go whole. Without
    ``passage_words`` only chunks of two or more lines go; with it, also every run of lines over
    so many words that stood before, in an earlier document or earlier in its own without
    overlap. ``n_removed_chunks`` counts the chunks of which no line stays. Null text stays null, with 0 lines; the empty text is one empty line. Texts are
    read whole. Rows without an id are returned unchanged and compared with nothing. Rows
    that repeat an id are decided together: equal rows keep or lose the same lines. Other
    columns are ignored; an empty table gives an empty table.
    """
    bounded_batches(df)
    extras = [c for c in df.columns if c not in (id_col, text_col, *_COUNTS)] if keep else []
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                     *(F.col(c).alias(f"_x{k}") for k, c in enumerate(extras)))
    id_type = dict(docs.dtypes)["_id"]

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, _signed(xxhash.xxh3_64_intdigest(t)), s, e - s, *_digest(t[s:e]))
                    for i, t in zip(b["_id"], b["_text"]) if t
                    for s, e in sorted(pieces(t, chunks(t, window, divisor), passage_words))]
            yield pd.DataFrame(rows, columns=["_id", "row", "start", "size", "h1", "h2"])

    found = materialize(docs.filter("_id is not null").select("_id", "_text").mapInPandas(
        hashes, f"_id {id_type}, row long, start int, size int, h1 long, h2 long"), "pieces")
    repeated = (found.groupBy("h1", "h2")
                .agg(F.min(F.struct("_id", "row", "start")).alias("f"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").drop("n"))
    own_text = F.col("f._id").eqNullSafe(F.col("_id")) & (F.col("f.row") == F.col("row"))
    marked = materialize(
        found.join(repeated, ["h1", "h2"])
        .withColumn("first", own_text & (F.col("f.start") == F.col("start")))
        .filter(F.col("first") | ~own_text | (F.col("f.start") + F.col("size") < F.col("start")))
        .groupBy("_id").agg(F.collect_set(F.struct("row", "start", "h1", "h2", "first"))
                            .alias("_marked")), "marked")  # as many as the document has pieces

    # both readers below start from this join: one exchange of the texts, used twice
    joined = docs.join(marked, "_id", "left")

    def own(t: str, marks, spans) -> Iterator[tuple]:
        """(start, end, key, first) of the marked pieces of a text."""
        row = _signed(xxhash.xxh3_64_intdigest(t))
        want = {(m["start"], m["h1"], m["h2"]): m["first"] for m in marks if m["row"] == row}
        starts = {k[0] for k in want}
        for s, e in pieces(t, spans, passage_words) if want else ():
            key = (s, *_digest(t[s:e])) if s in starts else None
            if key in want:
                yield s, e, key, want[key]

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, marks in zip(b["_id"], b["_text"], b["_marked"]):
                if marks is None or not t:
                    continue
                rows += [(i, *key, first, t[s:e])
                         for s, e, key, first in own(t, marks, chunks(t, window, divisor))]
            yield pd.DataFrame(rows, columns=["_id", "start", "h1", "h2", "first", "body"])

    texts = joined.mapInPandas(
        bodies, f"_id {id_type}, start int, h1 long, h2 long, first boolean, body string")
    one = texts.filter("first").groupBy("h1", "h2").agg(F.min("body").alias("_first_body"))
    # byte comparison: a piece whose hashes agree with the first occurrence but whose bytes do not
    unequal = (texts.filter("not first").join(one, ["h1", "h2"])
               .filter(F.col("body") != F.col("_first_body"))
               .groupBy("_id").agg(F.collect_set(F.struct("start", "h1", "h2")).alias("_unequal")))

    @F.pandas_udf(f"text string, {', '.join(f'{c} long' for c in _COUNTS)}")
    def cut(texts: pd.Series, marked: pd.Series, unequal: pd.Series) -> pd.DataFrame:
        rows = []
        for t, marks, wrong in zip(texts, marked, unequal):
            if not isinstance(t, str):
                rows.append((None, 0, 0, 0, 0))
                continue
            wrong = {(m["start"], m["h1"], m["h2"]) for m in (wrong if wrong is not None else ())}
            spans = chunks(t, window, divisor)
            lines, starts = t.split("\n"), [0]
            for line in lines:
                starts.append(starts[-1] + len(line) + 1)
            gone = [False] * len(lines)
            for s, e, key, first in own(t, marks, spans) if marks is not None and t else ():
                if not first and key not in wrong:
                    a, z = bisect_left(starts, s), bisect_left(starts, e + 1)
                    gone[a:z] = [True] * (z - a)
            text = "\n".join(x for x, out in zip(lines, gone) if not out) if any(gone) else t
            at, lost = 0, 0
            for s in spans:
                lost += all(gone[at:at + s[2]])
                at += s[2]
            rows.append((text, at, len(spans), lost, sum(gone)))
        return pd.DataFrame(rows, columns=["text", *_COUNTS])

    done = joined.join(unequal, "_id", "left").withColumn("_cut", cut("_text", "_marked", "_unequal"))
    placed = {id_col: F.col("_id"), text_col: F.col("_cut.text"),
              **{c: F.col(f"_x{k}") for k, c in enumerate(extras)}}
    order = [c for c in df.columns if c in placed] if keep else [id_col, text_col]
    return done.select(*(placed[c].alias(c) for c in order),
                       *(F.col(f"_cut.{c}").alias(c) for c in _COUNTS))
