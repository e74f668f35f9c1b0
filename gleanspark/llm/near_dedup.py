"""Near-duplicate documents: MinHash signatures and a multi-index Hamming join (operator 5).

1. Every text gives its set of shingle hashes, a 128-bit digest of the set, and a signature
   of ``symbols`` minima cut to 16 bits. Rows with equal sets become one class, represented
   by the smallest id; copies never meet again.
2. Signatures are split into ``chunks``. Two signatures that differ in at most
   T = chunks * (errors + 1) - 1 symbols have, by the pigeonhole principle, a chunk with at
   most ``errors`` differing symbols. Each chunk is indexed once for every choice of
   ``errors`` symbols left out, so all pairs within T share a key, and most pairs beyond T
   too. A pair at exactly ``percent`` shares none with the chance ``miss`` gives: 4.0e-10 at
   85 and 1.1e-7 at 80 (60 symbols, 12 chunks, one error). ``plan`` takes narrower chunks, or
   more symbols, for a lower ``percent``, so that it is at most ``MISS`` at any threshold.
3. Star round: every class of a key is compared with the key's smallest on the full sets;
   confirmed links are joined into components.
4. Closing round: only keys whose classes still lie in two or more components remain; classes
   that such keys connect are a family. Inside tasks, in tiles of bounded size, the classes of
   a family are compared across components on the full sets, and only links that join two
   components come out. So every pair that shares a key is either inside one component or was tested,
   and no group's pairs are ever listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.common import bounded_batches, materialize
from gleanspark.llm.components import components
from gleanspark.llm.shingles import mix, odd_constants, shingle_sets

MISS = 2e-6                                      # pairs at the threshold that share no key, at most
TILE = 256                                       # classes of a family compared at once, a side
SET_BYTES = 1 << 20                              # full sets sent on at once


def miss(percent: int, symbols: int, chunks: int, errors: int) -> float:
    """Chance that two sets at exactly ``percent`` similarity share no key: in every chunk
    more than ``errors`` symbols differ."""
    width, p = symbols // chunks, 1 - percent / 100
    meet = sum(comb(width, k) * p ** k * (1 - p) ** (width - k) for k in range(min(errors, width) + 1))
    return max(0.0, 1 - meet) ** chunks


def plan(percent: int, symbols: int | None = None, chunks: int | None = None,
         errors: int | None = None) -> tuple[int, int, int]:
    """(symbols, chunks, errors): what is given stays; the rest is the widest chunks, with one
    error, and then the fewest symbols from 60 on that miss at most ``MISS``."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    e = 1 if errors is None else errors
    for s in (symbols,) if symbols is not None else range(60, 6001, 60):
        for c in (chunks,) if chunks is not None else [s // w for w in (5, 4, 3, 2) if s % w == 0 and w > e]:
            if miss(percent, s, c, e) <= MISS or None not in (symbols, chunks):
                return s, c, e
    raise ValueError(f"no index finds pairs at {percent} percent: give more symbols")


def signature(hashes: np.ndarray, salts: np.ndarray, mults: np.ndarray) -> np.ndarray:
    """16 bits of the element with the smallest value under each of the hash functions."""
    low = np.full(len(salts), np.iinfo("uint64").max, "uint64")
    for at in range(0, len(hashes), 4096):       # bounded memory on very long texts
        part = (hashes[at:at + 4096][None, :] ^ salts[:, None]) * mults[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (mix(low) >> np.uint64(48)).astype("<u2")


def chunk_keys(sigs: np.ndarray, chunks: int, errors: int) -> np.ndarray:
    """(rows, keys): for each chunk and each choice of symbols left out, the rest hashed."""
    n, symbols = sigs.shape
    width, keys = symbols // chunks, []
    wide = sigs.astype("uint64")
    weights = odd_constants(width, 0xC0DE)
    for c in range(chunks):
        part = wide[:, c * width:(c + 1) * width]
        for out in combinations(range(width), errors):
            stay = [j for j in range(width) if j not in out]
            tag = np.uint64(sum(1 << j for j in out) + (c << 32))
            keys.append(mix((part[:, stay] + np.uint64(1)) @ weights[stay] + mix(tag * weights[:1])))
    return np.stack(keys, axis=1).astype("int64") if keys else np.empty((n, 0), "int64")


def describe(docs: DataFrame, size: int, symbols: int) -> DataFrame:
    """``_id, n, f1, f2, sig``: shingles, digest of the set, signature (null if empty)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salts, mults = odd_constants(symbols, 1), odd_constants(symbols, 2)
        for b in batches:
            rows = []
            for i, h in zip(b["_id"], shingle_sets(list(b["_text"]), size)):
                d = xxhash.xxh3_128_intdigest(h.tobytes())
                rows.append((i, len(h), (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63),
                             signature(h, salts, mults).tobytes() if len(h) else None))
            yield pd.DataFrame(rows, columns=["_id", "n", "f1", "f2", "sig"])
    return docs.mapInPandas(run, f"_id {dict(docs.dtypes)['_id']}, n long, f1 long, f2 long, sig binary")


def _index(classes: DataFrame, id_type: str, symbols: int, chunks: int, errors: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1024):
                part = b.iloc[at:at + 1024]
                sigs = np.frombuffer(b"".join(part["sig"]), "<u2").reshape(-1, symbols)
                keys = chunk_keys(sigs, chunks, errors)
                yield pd.DataFrame({"key": keys.ravel(),
                                    "rep": np.repeat(part["rep"].to_numpy(), keys.shape[1])})
    return classes.select("rep", "sig").mapInPandas(run, f"key long, rep {id_type}")


@F.pandas_udf(T.IntegerType())
def shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """Common elements of two sets of sorted 64-bit hashes."""
    return pd.Series([len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"),
                                         assume_unique=True)) for x, y in zip(a, b)], dtype="int32")


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``rep, set`` of the wanted ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, sets, held = [], [], 0
            for i, h in zip(b["_id"], shingle_sets(list(b["_text"]), size)):
                ids.append(i)
                sets.append(h.astype("<u8").tobytes())
                held += len(sets[-1])
                if held >= SET_BYTES:
                    yield pd.DataFrame({"rep": ids, "set": sets})
                    ids, sets, held = [], [], 0
            yield pd.DataFrame({"rep": ids, "set": sets})
    # the side that is hashed holds ids only, a few megabytes a task; texts are not sorted
    some = docs.join(wanted.withColumnRenamed("rep", "_id").hint("shuffle_hash"), "_id", "left_semi")
    return some.mapInPandas(run, f"rep {dict(docs.dtypes)['_id']}, set binary")


def _confirm(pairs: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose sets are similar; sizes too far apart rule a pair out."""
    def side(frame: DataFrame, key: str, name: str) -> DataFrame:
        return frame.select(F.col("rep").alias(key), F.col(name).alias(f"{name}_{key}"))

    close = (pairs.join(side(sizes, "a", "n"), "a").join(side(sizes, "b", "n"), "b")
             .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b"))
    both = close.join(side(sets, "a", "set"), "a").join(side(sets, "b", "set"), "b")
    n_a, n_b = (F.octet_length(f"set_{k}") / 8 for k in "ab")
    counted = both.select("a", "b", shared("set_a", "set_b").alias("n"), (n_a + n_b).alias("sum"))
    return counted.filter(100 * F.col("n") >= percent * (F.col("sum") - F.col("n"))).select("a", "b")


def _rare_pairs(sets: list[np.ndarray], percent: int) -> set[tuple[int, int]]:
    """Pairs that share an element among their rarest: without one, they cannot be similar.

    Elements are ordered by how few of the sets hold them. Two sets of similarity ``percent``
    share so many elements that their first ``n - ceil(percent * n / 100) + 1`` meet.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), "int64")
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    order = np.lexsort((rank[place], owner))
    nth = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = nth < (sizes - (percent * sizes + 99) // 100 + 1)[owner]
    order = order[first & (count[place[order]] > 1)]
    order = order[np.argsort(place[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    pairs: set[tuple[int, int]] = set()
    for held in {tuple(h) for h in map(np.ndarray.tolist, np.split(owner[order], cuts))}:
        pairs.update(combinations(held, 2))
    return pairs


def _close_families(members: DataFrame, id_type: str, percent: int) -> DataFrame:
    """Links (a, b) between different components of a family, as many as join them.

    A family of n classes is split into ceil(n / TILE) parts by hash; each pair of parts is a
    group of its own, so no group is larger than two parts. Within a group, pairs across
    components that share a rare element are compared on the full sets, and only links that
    join two components leave the task.
    """
    parts = F.expr(f"cast(ceil(n / {TILE}) as int)")
    dealt = (members.withColumn("own", F.pmod(F.xxhash64("rep"), parts).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .withColumn("ta", F.least("own", "other")).withColumn("tb", F.greatest("own", "other"))
             .drop("own", "other", "n"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, "<u8") for x in group["set"]]
        ids, comp = group["rep"].tolist(), group["comp"].tolist()
        root: dict = {}

        def find(c):
            while c in root:
                c = root[c]
            return c

        out = []
        for i, j in sorted(_rare_pairs(sets, percent)) if len(set(comp)) > 1 else ():
            ci, cj = find(comp[i]), find(comp[j])
            small, large = sorted((len(sets[i]), len(sets[j])))
            if ci == cj or 100 * small < percent * large:
                continue
            n = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * n >= percent * (small + large - n):
                root[ci] = cj
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("family", "ta", "tb").applyInPandas(compare, f"a {id_type}, b {id_type}")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
               percent: int = 80, symbols: int | None = None, chunks: int | None = None,
               errors: int | None = None) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row.

    Two texts are linked if ``100 * |A & B| >= percent * |A | B|`` on their shingle sets;
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the
    row's own. Links are found but for a chance of at most ``MISS`` a pair at the threshold
    (``plan``; ``symbols``, ``chunks`` and ``errors`` that are given are used as they are). Texts are lower-cased (A-Z) and split on white space; shorter texts are one
    shingle. Null, empty and blank texts have no shingle, stay alone and are kept. Rows that
    repeat an id are one node with the links of each. A row without id has a null
    ``component_id``, is kept and links nothing. Other columns are ignored; an empty table
    gives an empty table.
    """
    bounded_batches(df)
    symbols, chunks, errors = plan(percent, symbols, chunks, errors)
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = dict(docs.dtypes)["_id"]
    prints = materialize(describe(docs, size, symbols), "prints")
    classes = materialize(
        prints.filter("n > 0 and _id is not null").groupBy("n", "f1", "f2")
        .agg(F.min("_id").alias("rep"), F.min("sig").alias("sig")), "classes")

    keys = _index(classes, id_type, symbols, chunks, errors)
    heads = (keys.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("_last"))
             .filter("head != _last").drop("_last"))
    met = materialize(keys.join(heads, "key").distinct(), "met")   # (key, rep, head), shared keys only
    sets = materialize(_full_sets(docs, met.select("rep").distinct(), size), "sets")

    tested = materialize(met.filter("rep != head").select(
        F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = materialize(_confirm(tested, classes.select("rep", "n"), sets, percent), "links")
    comps = components(links)

    placed = met.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", "head", F.coalesce("component", "rep").alias("comp"))
    open_keys = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .filter("lo != hi").select("key"))
    still = materialize(placed.join(open_keys, "key").select("rep", "head", "comp").distinct(), "open")
    if not still.isEmpty():
        family = components(still.select(F.col("rep").alias("a"), F.col("head").alias("b")))
        members = (still.select("rep", "comp").distinct()
                   .join(family.select(F.col("id").alias("rep"), F.col("component").alias("family")), "rep"))
        sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
        full = members.join(sizes, "family").join(sets, "rep")
        late = materialize(_close_families(full, id_type, percent), "late")
        comps = components(links.unionByName(late))

    out = (prints.join(classes.drop("sig"), ["n", "f1", "f2"], "left")
           .join(comps.withColumnRenamed("id", "rep"), "rep", "left"))
    own = F.when(F.col("_id").isNotNull(), F.coalesce("component", "rep", "_id"))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                      own.alias("component_id"),
                      (F.col("_id").isNull() | (F.col("_id") == own)).alias("kept"))
