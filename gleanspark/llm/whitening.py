"""Embedding whitening by bit-sliced scatter (operator 11).

Every entry becomes an integer. Shifted by the least value of its dimension, it is cut into
bit planes; a plane of 64 rows is one machine word. For every pair of planes the words are
AND-ed and their bits counted, and the counts, weighted by the two place values, add up to
the exact cross-products of the dimensions. Tasks send D * (D + 1) / 2 sums each; the D x D
matrix is centred in integers (n * sum(xy) - sum(x) * sum(y)), so nothing cancels, and only
then becomes doubles for ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.common import materialize

#: Rows whose planes are packed at once (1,024 words a plane).
BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class Whitener:
    """The fitted model: bounded by the dimension, whatever the number of rows."""
    n: int
    low: list[int]                    # least value of each dimension
    high: list[int]
    sums: list[int]                   # exact
    trace: float
    eigenvalues: np.ndarray           # falling, at most ``components``
    vectors: np.ndarray               # (dimensions, components), unit columns
    usable: np.ndarray                # eigenvalue above the rounding of eigh

    @property
    def dims(self) -> int:
        return len(self.low)


def usable_vector(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c)
                   | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def integer_entries(df: DataFrame, vector_col: str, scale: int, offset: int) -> DataFrame:
    """``df`` without unusable vectors, with ``_x``: floor(scale * c) + offset of each entry.
    An integer that does not fit a long is an error (ANSI), never wrapped."""
    x = F.transform(vector_col, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset))
    # inside the condition: filters may be merged, and an infinite entry has no integer
    return df.withColumn("_x", F.when(usable_vector(F.col(vector_col)), x)).filter("_x is not null")


def pack_planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """(planes, words): plane ``b`` of dimension ``d`` packed over the rows, 64 to a word."""
    rows, words = len(shifted), -(-len(shifted) // 64)
    out = np.zeros((sum(bits), words * 8), dtype=np.uint8)
    at = 0
    for d, count in enumerate(bits):
        column = np.ascontiguousarray(shifted[:, d])
        for b in range(count):
            out[at, :-(-rows // 8)] = np.packbits((column >> b).astype(np.uint8) & 1)
            at += 1
    return out.view(np.uint64)


def plane_counts(planes: np.ndarray) -> np.ndarray:
    """Common bits of every pair of planes (upper triangle)."""
    out = np.zeros((len(planes), len(planes)), dtype=np.int64)
    for i in range(len(planes)):
        out[i, i:] = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
    return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    held, rows = [], 0
    for batch in batches:
        part = _matrix(batch.column(0), dims)
        for at in range(0, len(part), BLOCK_ROWS):
            held.append(part[at:at + BLOCK_ROWS])
            rows += len(held[-1])
            if rows >= BLOCK_ROWS:
                yield np.concatenate(held)
                held, rows = [], 0
    if held:
        yield np.concatenate(held)


def cross_products(entries: DataFrame, low: list[int], high: list[int]) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross-products of the entries less ``low`` (upper triangle)."""
    dims = len(low)
    bits = [int(h - lo).bit_length() for lo, h in zip(low, high)]
    first = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    shift = np.array(low, dtype=np.int64)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for block in _blocks(batches, dims):
            c = plane_counts(pack_planes(block - shift, bits))
            counts = c if counts is None else counts + c
        if counts is None:
            return
        rows = []
        for i in range(dims):
            a = slice(first[i], first[i + 1])
            own = np.diagonal(counts)[a]                     # bits of the plane itself
            rows.append((i, -1, sum(int(v) << b for b, v in enumerate(own))))
            for j in range(i, dims):
                part = counts[a, first[j]:first[j + 1]]
                if i == j:                                   # the lower triangle mirrors it
                    part = part + np.triu(part, 1).T
                rows.append((i, j, sum(int(v) << (b + c) for (b, c), v in np.ndenumerate(part) if v)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([str(r[2]) for r in rows])], ["i", "j", "dot"])

    parts = entries.select("_x").mapInArrow(partial, "i int, j int, dot string")
    total = parts.groupBy("i", "j").agg(F.sum(F.col("dot").cast("decimal(38,0)")).alias("dot"))
    sums, dots = [0] * dims, [[0] * dims for _ in range(dims)]
    for r in total.collect():                                # D * (D + 3) / 2 rows
        if r["j"] < 0:
            sums[r["i"]] = int(r["dot"])
        else:
            dots[r["i"]][r["j"]] = dots[r["j"]][r["i"]] = int(r["dot"])
    return sums, dots


def fit(entries: DataFrame, components: int = 32) -> Whitener | None:
    """The whitening of all rows of ``entries`` (column ``_x``, one length); None if empty."""
    ranges = (entries.select(F.posexplode("_x").alias("d", "v")).groupBy("d")
              .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
              .orderBy("d").collect())                       # one row a dimension
    if not ranges:
        return None
    n, low, high = ranges[0]["n"], [r["lo"] for r in ranges], [r["hi"] for r in ranges]
    sums, dots = cross_products(entries, low, high)
    dims = len(low)
    v = np.array([[(n * dots[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)]
                  for i in range(dims)])
    values, vectors = np.linalg.eigh(v)
    top = np.argsort(-values, kind="stable")[:components]
    trace = sum(n * dots[i][i] - sums[i] * sums[i] for i in range(dims)) / (n * n)
    return Whitener(n, low, high, [s + n * lo for s, lo in zip(sums, low)], trace,
                    values[top], vectors[:, top],
                    values[top] > max(trace, 0.0) * dims * np.finfo(float).eps)


def apply(entries: DataFrame, model: Whitener, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, ``deviation`` and ``whitened`` (one entry a component, null where the
    component has no variance). ``deviation`` is the exact sum of (n * x - S) ** 2: a long
    where the bound of the data fits one, else decimal(38, 0)."""
    n, dims = model.n, model.dims
    reach = max(max(abs(n * lo - s), abs(n * h - s)) for lo, h, s in zip(model.low, model.high, model.sums))
    fits = reach * reach * dims < 2**63
    sums = np.array(model.sums, dtype=np.int64 if fits and max(map(abs, model.sums)) * 2 < 2**63 else object)
    scale = np.where(model.usable, 1 / np.sqrt(np.where(model.usable, model.eigenvalues, 1.0)), 0.0)
    project = model.vectors * scale
    usable = model.usable.tolist()
    schema = T.StructType([entries.schema[c] for c in keep] + [
        T.StructField("deviation", T.LongType() if fits else T.DecimalType(38, 0)),
        T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(batch.num_columns - 1), dims)
            apart = (x if sums.dtype != object else x.astype(object)) * n - sums
            deviation = (apart * apart).sum(axis=1)
            white = (apart.astype(np.float64) / n) @ project
            flat = pa.array(white.ravel(), mask=np.tile(~np.array(usable), len(white)))
            ends = pa.array(np.arange(len(white) + 1) * len(usable), pa.int32())
            deviation = (pa.array(deviation.astype(np.int64)) if fits else
                         pa.array([str(int(v)) for v in deviation]).cast(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), deviation,
                 pa.ListArray.from_arrays(ends, flat)], [f.name for f in schema])

    return entries.select(*keep, "_x").mapInArrow(rows, schema)


def identity_error(whitened: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of ``whitened``, less the identity, over the
    components that have variance; taken from the rows themselves."""
    live = np.flatnonzero(model.usable)
    if not len(live):
        return 0.0
    k = len(model.usable)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((len(live), len(live))), np.zeros(len(live))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[:, live]
            gram, total = gram + w.T @ w, total + w.sum(axis=0)
        flat = np.concatenate([gram.ravel(), total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)],
                                         ["at", "v"])

    parts = whitened.select("whitened").mapInArrow(partial, "at int, v double")
    got = dict(parts.groupBy("at").agg(F.sum("v").alias("v")).collect())
    flat = np.array([got[i] for i in range(len(got))])
    gram, mean = flat[:-len(live)].reshape(len(live), -1) / model.n, flat[-len(live):] / model.n
    return float(np.abs(gram - np.outer(mean, mean) - np.eye(len(live))).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           scale: int = 64, offset: int = 1_000_000) -> tuple[DataFrame, Whitener | None, float]:
    """(rows, model, identity error); rows are ``id_col, deviation, whitened``.

    Vectors that are null or hold a null, NaN or infinite entry are left out, also of the
    fit. Vectors have one length; where lengths differ, the most frequent one (the longest
    of equals) counts and other rows are left out. Rows that repeat an id or a vector count
    each; a null id stays. A component without variance (a constant dimension, fewer rows
    than components) has null entries. Without usable rows, and where vectors are empty,
    the result is empty and the model None. Other columns, whatever their names, are ignored.
    Eigenvectors of equal eigenvalues, and signs, are any that ``eigh`` gives; all rows share them.
    """
    slim = df.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v"))
    entries = integer_entries(slim, "_v", scale, offset)
    lengths = entries.groupBy(F.size("_x").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).head(1)
    dims = lengths[0]["k"] if lengths else 0
    entries = entries.filter(F.size("_x") == dims).select("_id", "_x")
    model = fit(entries, components) if dims else None
    if model is None:
        none = T.StructType([T.StructField(id_col, df.schema[id_col].dataType),
                             T.StructField("deviation", T.LongType()),
                             T.StructField("whitened", T.ArrayType(T.DoubleType()))])
        return df.sparkSession.createDataFrame([], none), None, 0.0
    out = materialize(apply(entries, model, ("_id",)), "whitened")
    return out.withColumnRenamed("_id", id_col), model, identity_error(out, model)
