"""Removal of repeated byte strings by distributed prefix doubling (operator 3).

A byte goes if it lies in a string of ``length`` bytes that also starts earlier in the
corpus. Prefix doubling ranks positions by ever longer prefixes: positions are sorted by the
pair (rank here, rank one offset on), ranked anew, and left out once they are unique or the
prefix is past the threshold. Ranking every byte of the corpus from the start would sort
thousands of millions of rows in each round, so the early rounds run on sampled positions:

round 1  Every window of ``length`` bytes is represented by the smallest hash among its
         ``GRAM``-byte strings (its anchor, a rank of the 20-byte prefix there). Neighbouring
         windows that share an anchor are one block, about one for 41 bytes. Equal windows
         have equal anchors, so blocks whose anchor is unique hold no repeat and are done.
round 2  Blocks of one anchor are sorted by the pair (anchor, rank of the block with the
         bytes its windows reach). Of equal blocks all but the first are repeats as a whole.
         An anchor with a single such class is done.
round 3  Only for anchors with several classes the windows themselves are taken, those of
         the first block of each class, and sorted by the pair (rank of the first half at p,
         rank at p + offset). Past the threshold now: all but the first of equal pairs repeat.
         Equal windows share their anchor, so the bytes of the blocks meet by anchor (140
         bytes instead of 41 pairs) and the pairs are sorted inside the task.

An anchor with over ``SMALL`` classes, too many for one task, has its blocks ranked anew by a
longer prefix: they are cut again, at anchors of four fifths of ``length``, and rounds 2 and 3
are run on these parts, about one for 8 windows. A string of 20 bytes that many texts share
stands in different surroundings, so nearly all longer anchors are unique and done. Only parts
whose longer anchor has over ``SMALL`` classes again send the pairs themselves to a sort.

Ranks are 64-bit hashes, so ranking needs no second pass; a pair has 128 bits. Blocks that
repeat within 16 MB of a task's text are settled there and only the first is shuffled: a
passage that a third of all documents share is a row per batch. The text is shuffled once,
by id, and read twice from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import bounded_batches, materialize
from gleanspark.llm.shingles import mix, odd_constants

GRAM = 20                       # bytes of the anchor's prefix
_COUNT = (1 << 31) - 1
SMALL = 2048                    # classes of one anchor compared inside a task
GROUP_BYTES = 1 << 18           # bytes hashed together: arrays stay in the cache


def ranks(data: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Rank (hash) of the ``n``-byte string at every position, by doubling."""
    if len(data) < n:
        return np.empty(0, "uint64")
    table, steps = odd_constants(256, salt), odd_constants(64, salt + 1)
    power, have, out, done = table[data], 1, None, 0
    while True:
        if n & have:            # append this power of two to what is done
            size = len(data) - done - have + 1
            out = power[:size] if out is None else \
                out[:size] * steps[done.bit_length()] + power[done:done + size]
            done += have
        if done == n:
            return mix(out)
        power = power[:-have] * steps[32 + have.bit_length()] + power[have:]
        have *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:-(w - have)], x[w - have:]) if w > have else x


def blocks(texts: list[bytes], length: int, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups of (text number, first window, windows, anchor, class) as parallel arrays."""
    group: list[int] = []
    held = 0
    for k, t in enumerate(texts):
        if len(t) < length:
            continue
        if group and held + len(t) > GROUP_BYTES:
            yield _blocks_of(texts, group, length, gram)
            group, held = [], 0
        group.append(k)
        held += len(t)
    if group:
        yield _blocks_of(texts, group, length, gram)


def _blocks_of(texts, group, length, gram):
    joined = b"".join(texts[k] for k in group)
    sizes = np.array([len(texts[k]) for k in group])
    starts = np.cumsum(sizes) - sizes
    grams = ranks(np.frombuffer(joined, "uint8"), gram, 11)
    anchor = sliding_min(grams, length - gram + 1)           # one per window, text borders ignored
    new = np.ones(len(anchor) + 1, bool)                     # a block starts at window p
    new[1:-1] = (grams[:len(anchor) - 1] == anchor[:-1]) | (anchor[1:] < anchor[:-1])
    new[starts] = True
    past = starts + sizes - length + 1                       # first position that is no window
    new[past[past < len(new)]] = True
    edge = np.flatnonzero(new)
    first, end = edge[:-1], edge[1:]
    of = np.searchsorted(starts, first, side="right") - 1
    real = first < past[of]                                  # not across two texts
    first, end, of = first[real], end[real], of[real]
    digest = xxhash.xxh3_64_intdigest
    tail = length - 1
    cls = np.array([digest(joined[b:e + tail]) for b, e in zip(first.tolist(), end.tolist())], "uint64")
    return np.array(group)[of], first - starts[of], end - first, anchor[first], cls


def _pack(start, n, repeat):
    """One long: start, count (31 bits each) and the repeat bit."""
    return (start.astype("int64") << 32) | (n.astype("int64") << 1) | repeat


def _found(ids: np.ndarray, texts: list[bytes], offset: np.ndarray, length: int, gram: int) -> pd.DataFrame:
    """The blocks of texts in ascending (id, offset), and the bytes of each: the first of each
    class, and runs (without bytes) of those that repeat it. ``offset`` is what a text is cut off at."""
    parts = list(blocks(texts, length, gram))
    if not parts:
        return pd.DataFrame({"_id": [], "at": [], "anchor": [], "cls": [], "body": []})
    of, first, n, anchor, cls = (np.concatenate(c) for c in zip(*parts))
    start = first + offset[of]
    order = np.argsort(anchor ^ mix(cls), kind="stable")     # equal blocks side by side, in order
    a, c = anchor[order], cls[order]
    same = np.concatenate([[False], (a[1:] == a[:-1]) & (c[1:] == c[:-1])])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    lead = order[head]
    later = same & ((ids[of[order]] != ids[of[lead]]) | (start[order] != start[lead]))
    repeat = np.zeros(len(order), bool)
    repeat[order] = later
    # repeats that touch, in one text, become one run
    idx = np.flatnonzero(repeat)
    fresh = np.ones(len(idx), bool)
    fresh[1:] = (np.diff(idx) != 1) | (of[idx[1:]] != of[idx[:-1]])
    runs = np.flatnonzero(fresh)
    run_first = idx[runs]
    run_n = np.add.reduceat(n[idx], runs) if len(idx) else np.empty(0, "int64")
    rest = ~repeat
    tail = length - 1
    body = [texts[k][b:b + m + tail] for k, b, m in zip(of[rest].tolist(), first[rest].tolist(), n[rest].tolist())] \
        if gram != GRAM else [None] * rest.sum()             # whole texts meet their blocks again
    return pd.DataFrame({
        "_id": np.concatenate([ids[of[rest]], ids[of[run_first]]]),
        "at": np.concatenate([_pack(start[rest], n[rest], 0), _pack(start[run_first], run_n, 1)]),
        # a run takes part in no class: a key of its own
        "anchor": np.concatenate([anchor[rest], anchor[run_first] ^ np.uint64(0xA5A5)]).astype("int64"),
        "cls": np.concatenate([cls[rest], mix(cls[run_first] + np.uint64(1))]).astype("int64"),
        "body": body + [None] * len(runs)})


def removed_mask(size: int, start: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by the windows ``start .. start + n`` of each run."""
    step = np.zeros(size + 1, "int64")
    np.add.at(step, start, 1)
    np.add.at(step, start + n - 1 + length, -1)
    return np.cumsum(step[:-1]) > 0


def _longs(x) -> np.ndarray:
    return np.asarray(x if x is not None else (), "int64")


def _spans(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at >> 32, (at >> 1) & _COUNT


def _late(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Round 3 for whole anchors, sorted by (anchor, id, place): runs of repeated windows."""
    half = length // 2
    rank = ranks(np.frombuffer(b"".join(rows["body"]), "uint8"), half, 21)
    start, n = _spans(rows["at"].to_numpy())
    size = n + length - 1
    row = np.repeat(np.arange(len(rows)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    byte = (np.cumsum(size) - size)[row] + inside
    r1, r2, key = rank[byte], rank[byte + length - half], rows["anchor"].to_numpy().astype("uint64")[row]
    order = np.argsort(mix(r1) ^ mix(r2 + key), kind="stable")   # equal pairs side by side, in order
    same = np.zeros(len(order), bool)
    same[1:] = True
    for v in (r1[order], r2[order], key[order]):
        same[1:] &= v[1:] == v[:-1]
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    ids, place = rows["_id"].to_numpy()[row], start[row] + inside
    later = np.zeros(len(order), bool)
    later[order] = same & ((ids[order] != ids[lead]) | (place[order] != place[lead]))
    idx = np.flatnonzero(later)
    fresh = np.ones(len(idx), bool)
    fresh[1:] = (np.diff(idx) != 1) | (row[idx[1:]] != row[idx[:-1]])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(idx)))
    return pd.DataFrame({"_id": ids[idx[first]], "at": _pack(place[idx[first]], count, 1)})


def repeats(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(joined, late): texts with their packed blocks, and the repeated windows of round 3."""
    id_type = dict(docs.dtypes)["_id"]

    def found(held: list[pd.DataFrame], gram: int) -> pd.DataFrame:
        b = pd.concat(held).sort_values(["_id", "offset"], kind="stable")
        out = _found(b["_id"].to_numpy(), b["_text"].tolist(), b["offset"].to_numpy("int64"), length, gram)
        return out if gram != GRAM else out.drop(columns="body")

    def scan(pieces: Iterator[pd.DataFrame], gram: int) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in pieces:                         # repeats are settled among 16 MB of text at once
            held.append(b)
            size += b["_text"].str.len().sum()
            if size >= 16 << 20:
                yield found(held, gram)
                held, size = [], 0
        if held:
            yield found(held, gram)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return scan((b.assign(_text=[t.encode("utf-8") for t in b["_text"]], offset=0) for b in batches), GRAM)

    rows = (docs.filter("_id is not null and _text is not null").mapInPandas(
        whole, f"_id {id_type}, at long, anchor long, cls long"))
    here = F.struct("_id", "at")

    def ranked(rows: DataFrame) -> DataFrame:
        """Rounds 1 and 2 in one sort by (anchor, class, place): ``again`` of what repeats,
        ``size`` of the anchor in classes; anchors of one class are left out but for repeats."""
        lead = F.first(here).over(Window.partitionBy("anchor", "cls").orderBy("_id", "at"))
        again = (F.col("at") % 2 == 1) | (F.col("lead") != here)
        size = F.sum(F.when(F.col("again"), 0).otherwise(1)).over(Window.partitionBy("anchor"))
        return (rows.repartition("anchor").withColumn("lead", lead).withColumn("again", again)
                .withColumn("size", size).filter("again or size > 1").withColumn("small", F.col("size") <= SMALL)
                .drop("lead", "size", "cls"))

    marked = materialize(ranked(rows).select(
        "_id", "again", "small",
        F.when(F.col("again"), F.col("at").bitwiseOR(F.lit(1))).otherwise(F.col("at")).alias("at"),
        F.when(~F.col("again"), F.col("anchor")).alias("anchor")), "blocks")
    # at most one entry per window of the document; _open and _anchor run in parallel
    lists = marked.groupBy("_id").agg(
        F.collect_list(F.when(F.col("again"), F.col("at"))).alias("_at"),
        F.collect_list(F.when(~F.col("again") & F.col("small"), F.col("at"))).alias("_open"),
        F.collect_list(F.when(~F.col("again") & F.col("small"), F.col("anchor"))).alias("_anchor"),
        F.collect_list(F.when(~F.col("again") & ~F.col("small"), F.col("at"))).alias("_large"))
    joined = docs.join(lists, "_id", "left")

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, at, anchor in zip(b["_id"], b["_text"], b["_open"], b["_anchor"]):
                if at is not None and len(at):
                    data, at = t.encode("utf-8"), _longs(at)
                    start, n = _spans(at)
                    out += [(k, i, p, data[s:s + m + length - 1]) for k, p, s, m in
                            zip(_longs(anchor).tolist(), at.tolist(), start.tolist(), n.tolist())]
            yield pd.DataFrame(out, columns=["anchor", "_id", "at", "body"])

    def late_rows(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(late=True, r1=rows["at"], r2=np.arange(len(rows)))[["_id", "at", "late", "r1", "r2"]]

    def windows(rows: pd.DataFrame) -> pd.DataFrame:
        half = length // 2
        start, n = _spans(rows["at"].to_numpy())
        size, row = n + length - 1, np.repeat(np.arange(len(rows)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        byte = (np.cumsum(size) - size)[row] + inside
        rank = ranks(np.frombuffer(b"".join(rows["body"]), "uint8"), half, 21)
        return pd.DataFrame({"_id": rows["_id"].to_numpy()[row], "at": _pack(start[row] + inside, np.ones(len(row), "int64"), 1),
                             "late": False, "r1": rank[byte].astype("int64"),
                             "r2": rank[byte + length - half].astype("int64")})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:                        # sorted by anchor: whole anchors at a time
            if b["again"].any():
                yield late_rows(b[b["again"]])
            if not b["small"].all() and len(large := b[~b["again"] & ~b["small"]]):
                yield windows(large)
            b = b[~b["again"] & b["small"]]
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            open_ = (held["anchor"] == held["anchor"].iloc[-1]).to_numpy() if len(held) else ()
            if len(held) >= 4096 and not all(open_):
                yield late_rows(_late(held[~open_], length))
                held = held[open_]
        if held is not None and len(held):
            yield late_rows(_late(held, length))

    flags = f"_id {id_type}, at long, late boolean, r1 long, r2 long"
    met = (joined.mapInPandas(bodies, f"anchor long, _id {id_type}, at long, body binary")
           .repartition("anchor").sortWithinPartitions("anchor", "_id", "at")
           .withColumns({"again": F.lit(False), "small": F.lit(True)}))
    late = met.mapInPandas(compare, flags).select("_id", "at")

    def cut_anew(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pieces() -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for i, t, at in zip(b["_id"], b["_text"], b["_large"]):
                    if at is not None and len(at):
                        data, (start, n) = t.encode("utf-8"), _spans(_longs(at))
                        out += [(i, data[s:s + m + length - 1], s) for s, m in zip(start.tolist(), n.tolist())]
                if out:
                    yield pd.DataFrame(out, columns=["_id", "_text", "offset"])

        return scan(pieces(), length * 4 // 5)

    parts = joined.mapInPandas(cut_anew, f"_id {id_type}, at long, anchor long, cls long, body binary")
    pairs = (ranked(parts).sortWithinPartitions("anchor", "_id", "at")
             .mapInPandas(compare, flags))
    lead = F.first(here).over(Window.partitionBy("late", "r1", "r2").orderBy("_id", "at"))
    large = pairs.withColumn("lead", lead).filter(F.col("late") | (F.col("lead") != here)).select("_id", "at")
    return joined, (late.unionByName(large).groupBy("_id").agg(F.collect_list("at").alias("_late")))


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = 100) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row; ``spans`` are
    (start, end) in bytes of the maximal removed runs, ``kept_sha256`` is of the bytes left.

    Texts are UTF-8 bytes; matches never cross rows, and strings are judged on the input.
    Null text counts as empty. Of equal strings the one with the smallest (id, start) stays.
    Rows that repeat an id are decided together, so equal rows keep the same bytes. Rows
    without an id are kept whole and compared with nothing. ``length`` is at least 40. Other
    columns are ignored; an empty table gives an empty table.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    bounded_batches(df)
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    joined, late = repeats(docs, length)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, at, more in zip(b["_id"], b["_text"], b["_at"], b["_late"]):
                data = t.encode("utf-8") if isinstance(t, str) else b""
                at, spans, kept = np.concatenate([_longs(at), _longs(more)]), [], data
                if len(at):
                    start, n = _spans(at)
                    gone = removed_mask(len(data), start, n, length)
                    kept = np.frombuffer(data, "uint8")[~gone].tobytes()
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    spans = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()]
                rows.append((i, len(data), len(data) - len(kept), len(spans),
                             hashlib.sha256(kept).hexdigest(), spans))
            yield pd.DataFrame(rows, columns=["_id", "n_bytes", "n_removed", "n_spans",
                                              "kept_sha256", "spans"])

    out = joined.join(late, "_id", "left").mapInPandas(
        cut, f"_id {dict(docs.dtypes)['_id']}, n_bytes long, n_removed long, n_spans long, "
             "kept_sha256 string, spans array<struct<start:long,end:long>>")
    return out.withColumnRenamed("_id", id_col)
