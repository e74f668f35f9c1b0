"""Benchmark decontamination by greedy string tiling (operator 1).

Documents and benchmark items are words. A document and an item that share a seed (a run
of ``min_match`` words) are compared by greedy string tiling over a heap: windows of
``min_match`` words are found by a Karp-Rabin rolling hash, equal ones are extended word by
word to maximal matches, and the longest free match is marked first. No rounds with a
shrinking search length are run; the tiles are those of greedy string tiling all the same.
The share of the item that tiles cover does not depend on their order, so reordered
passages count in full.

The benchmark is broadcast only if its word count, measured first, is at most
``broadcast_words``; seeds are then looked up while the documents are scanned and nothing
is shuffled. A larger benchmark takes the other way: both sides' seeds are joined by a
shuffle, pairs are made distinct, and the tiling runs on the joined texts.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import bounded_batches, materialize, word_count

_WORD = re.compile(r"[^\W_]+")
_PRIME = 0x100000001B3
_TILES = "array<struct<item_start:int,doc_start:int,length:int>>"


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def tile(item: list[int], doc: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, length) of greedy string tiling.

    Negative numbers match nothing. Of equally long matches the first in the item, then in
    the document, is marked first. A match that a longer tile partly covers goes back to the
    queue as the pieces that are still free, so the longest free match is always next.
    """
    free_i, free_d = [x >= 0 for x in item], [x >= 0 for x in doc]
    tiles: list[tuple[int, int, int]] = []
    queue = [(-n, i, d) for n, i, d in _matches(item, doc, free_i, free_d, min_match)]
    heapq.heapify(queue)
    while queue:
        n, i, d = heapq.heappop(queue)
        open_ = [free_i[i + k] and free_d[d + k] for k in range(-n)] + [False]
        if all(open_[:-1]):
            free_i[i:i - n] = free_d[d:d - n] = [False] * -n
            tiles.append((i, d, -n))
            continue
        start = 0
        for k, free in enumerate(open_):
            if not free:
                if k - start >= min_match:
                    heapq.heappush(queue, (start - k, i + start, d + start))
                start = k + 1
    return sorted(tiles)


def _matches(item, doc, free_i, free_d, length):
    """(length, item start, document start) of the maximal matches of ``length`` or more."""
    at: dict[int, list[int]] = defaultdict(list)
    for d, h in _rolling(doc, free_d, length):
        at[h].append(d)
    matches, inside = [], set()
    for i, h in _rolling(item, free_i, length):
        for d in at.get(h, ()):
            if item[i:i + length] != doc[d:d + length]:
                continue                        # equal hashes, other words
            inside.add((i, d))
            if (i - 1, d - 1) in inside:
                continue                        # part of a match already extended
            n = length
            while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] >= 0:
                n += 1
            matches.append((n, i, d))
    return matches


def _rolling(seq, free, length):
    """(start, Karp-Rabin hash) of each window of ``length`` free words."""
    h, run, mask = 0, 0, (1 << 64) - 1
    out = pow(_PRIME, length, 1 << 64)
    for k, x in enumerate(seq):
        if not free[k]:
            h = run = 0
            continue
        h, run = (h * _PRIME + x + 1) & mask, run + 1
        if run > length:
            h = (h - (seq[k - length] + 1) * out) & mask
        if run >= length:
            yield k - length + 1, h


class Items:
    """The benchmark as numbers: vocabulary, token lists and seeds."""

    def __init__(self, rows: list[tuple], min_match: int):
        self.k = min_match
        self.vocab: dict[str, int] = {}
        self.items = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in words(t)])
                      for i, t in rows]
        self.mult = np.array([pow(_PRIME, self.k - 1 - j, 1 << 64) for j in range(self.k)], "uint64")
        by_seed: dict[int, set[int]] = defaultdict(set)
        for n, (_, toks) in enumerate(self.items):
            for code in self.codes(np.array(toks, "int64"))[1]:
                by_seed[int(code)].add(n)
        self.by_seed = {s: sorted(v) for s, v in by_seed.items()}
        self.seeds = np.array(sorted(by_seed), "uint64")

    def codes(self, toks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and codes of the windows of ``min_match`` known words."""
        n = len(toks) - self.k + 1
        if n <= 0:
            return np.empty(0, "int64"), np.empty(0, "uint64")
        codes, ok = np.zeros(n, "uint64"), np.ones(n, bool)
        for j in range(self.k):
            part = toks[j:j + n]
            ok &= part >= 0
            codes += (part.astype("uint64") + np.uint64(1)) * self.mult[j]
        return np.flatnonzero(ok), codes[ok]

    def tiles(self, text: str) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(item number, tiles) for each item that shares a seed with the text."""
        known = self.vocab.get
        toks = np.array([known(w, -1) for w in words(text)], "int64")
        starts, codes = self.codes(toks)
        if not len(starts) or not len(self.seeds):
            return
        place = np.minimum(np.searchsorted(self.seeds, codes), len(self.seeds) - 1)
        hit = self.seeds[place] == codes
        where: dict[int, list[int]] = defaultdict(list)
        for s, c in zip(starts[hit].tolist(), codes[hit].tolist()):
            for n in self.by_seed[c]:
                where[n].append(s)
        for n, at in where.items():
            # every tile lies in the windows that hold a seed: tile those, kept apart by -1
            part, origin, end = [], [], -1
            for s in at:
                if s > end:
                    part.append(-1)
                    origin.append(-1)
                    end = s
                part += toks[end:s + self.k].tolist()
                origin += range(end, s + self.k)
                end = s + self.k
            found = tile(self.items[n][1], part, self.k)
            yield n, [(i, origin[d], m) for i, d, m in found]


def _row(doc_id, item_id, n_words, tiles):
    covered = sum(m for *_, m in tiles)
    return (doc_id, item_id, n_words, covered, covered / n_words,
            [{"item_start": i, "doc_start": d, "length": m} for i, d, m in tiles])


_COLUMNS = ["_doc", "item_id", "item_words", "covered_words", "coverage", "tiles"]


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", min_match: int = 5,
          min_coverage: float = 0.5, broadcast_words: int = 2_000_000) -> DataFrame:
    """One row per document and benchmark item it leaks: ``id_col, item_id, item_words,
    covered_words, coverage, tiles`` (starts and lengths in words), where tiles of at least
    ``min_match`` words cover at least ``min_coverage`` of the item.

    Words are lower-cased runs of letters and digits. Null and empty texts, and items of
    fewer than ``min_match`` words, match nothing. Documents that repeat an id give one row
    per document and item; benchmark rows that repeat an id are items of their own, of
    which the best covered counts. Other columns are ignored; an empty table on either side
    gives an empty table.
    """
    bounded_batches(df)
    docs = df.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("_item"))
    schema = (f"_doc {dict(docs.dtypes)['_doc']}, item_id {dict(items.dtypes)['item_id']}, "
              f"item_words long, covered_words long, coverage double, tiles {_TILES}")
    total = items.agg(F.sum(word_count(F.col("_item")))).first()[0] or 0
    way = _scan_documents if total <= broadcast_words else _join_seeds
    return way(docs, items, schema, min_match, min_coverage).withColumnRenamed("_doc", id_col)


def _best(rows: list[tuple]) -> list[tuple]:
    best: dict = {}
    for r in rows:
        if r[1] not in best or r[4] > best[r[1]][4]:
            best[r[1]] = r
    return list(best.values())


def _scan_documents(docs, items, schema, min_match, min_coverage) -> DataFrame:
    """The benchmark is small (its size was checked): it is broadcast."""
    rows = [(r["item_id"], r["_item"]) for r in items.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bench = Items(shared.value, min_match)
        for b in batches:
            out = []
            for i, t in zip(b["_doc"], b["_text"]):
                if t:
                    out += _best([r for r in (
                        _row(i, bench.items[n][0], len(bench.items[n][1]), tiles)
                        for n, tiles in bench.tiles(t)) if r[4] >= min_coverage])
            yield pd.DataFrame(out, columns=_COLUMNS)

    return docs.mapInPandas(look, schema)


def _join_seeds(docs, items, schema, min_match, min_coverage) -> DataFrame:
    """The benchmark is large: seeds of both sides meet in a shuffle."""
    docs = docs.withColumn("_row", F.xxhash64("_doc", "_text"))
    items = items.withColumn("_irow", F.xxhash64("item_id", "_item"))

    def seeds(key: str, text: str):
        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for k, t in zip(b[key], b[text]):
                    w = words(t)
                    out += [(k, h) for h in {
                        xxhash.xxh3_64_intdigest(" ".join(w[j:j + min_match])) - (1 << 63)
                        for j in range(len(w) - min_match + 1)}]
                yield pd.DataFrame(out, columns=[key, "_seed"])
        return cut

    of_docs = docs.select("_row", "_text").mapInPandas(seeds("_row", "_text"), "_row long, _seed long")
    of_items = items.select("_irow", "_item").mapInPandas(seeds("_irow", "_item"),
                                                          "_irow long, _seed long")
    pairs = materialize(of_docs.join(of_items, "_seed").select("_row", "_irow").distinct(), "pairs")
    both = (docs.join(pairs, "_row").join(items, "_irow")
            .select("_doc", "_text", "item_id", "_item"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, t, i, q in zip(b["_doc"], b["_text"], b["item_id"], b["_item"]):
                one = Items([(i, q)], min_match)
                out += [r for r in (_row(d, i, len(one.items[0][1]), tiles)
                                    for _, tiles in one.tiles(t)) if r[4] >= min_coverage]
            yield pd.DataFrame(out, columns=_COLUMNS)

    found = both.mapInPandas(compare, schema)
    # benchmark rows that repeat an id: the best covered counts
    rest = [c for c in _COLUMNS if c not in ("_doc", "item_id", "coverage")]
    best = found.groupBy("_doc", "item_id").agg(F.max(F.struct("coverage", *rest)).alias("_b"))
    return best.select("_doc", "item_id", *(F.col(f"_b.{c}").alias(c) for c in _COLUMNS[2:]))
