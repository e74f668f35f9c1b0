"""Toxicity of texts after noisy-channel deobfuscation (operator 4).

1. A character language model is counted over every text of the corpus (letter 4-grams,
   folded to a-z: a table of a fixed million cells, whatever the corpus size).
2. Tokens are restored by ``deobfuscate``: look-alike symbols, repetition, spacing.
3. On a bounded sample of labelled rows the words and word beginnings that mark label 1 are
   found; a logistic function of how many and how strong marks a text has is fitted on rows
   of the sample that took no part in finding them.
4. Every text is restored whole and scored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import materialize
from gleanspark.llm.deobfuscate import Restorer, count_grams, log_model

PREFIXES = (3, 4, 5, 6, 7, 8)


class _Memo(dict):
    """Results by token; forgotten when full, so a worker's memory is bounded."""

    def __init__(self, make, entries: int = 200_000, longest: int = 40):
        super().__init__()
        self.make, self.entries, self.longest = make, entries, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value


class Reader:
    """Texts as restored words."""

    def __init__(self, log_p: np.ndarray):
        self.restorer = Restorer(log_p)
        self.memo = _Memo(self.restorer.token)

    def words(self, text: str | None) -> list[str]:
        tokens = (text or "").split()
        out = list(map(self.memo.__getitem__, tokens))
        alone = bytes(len(t) == 1 for t in tokens)
        at = alone.find(b"\1\1\1")                    # three lone characters: spaced letters
        if at >= 0:
            joined, done = [], 0
            while at >= 0:
                end = at
                while end < len(alone) and alone[end]:
                    end += 1
                run = tokens[at:end]
                joined += out[done:at]
                if len(set(run)) > 1:
                    joined.append(self.restorer.decode(" ".join(run).lower()))
                done, at = end, alone.find(b"\1\1\1", end)
            out = joined + out[done:]
        return [w for t in out for w in (t.split(" ") if " " in t else (t,)) if w]


def squeeze(word: str) -> str:
    """Repeated letters once: doubled letters do not hide a word."""
    return "".join(c for i, c in enumerate(word) if not i or c != word[i - 1])


def marks_of(word: str) -> list[str]:
    """The word and its beginnings, as features."""
    w = squeeze(word)
    return ["=" + w] + ["^" + w[:k] for k in PREFIXES if len(w) >= k]


def language_model(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P of the character model, from all texts; a million cells reach the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << 20, "int64")
        held, size = [], 0
        for b in batches:
            for t in b["_t"]:
                for at in range(0, len(t), 1 << 20):      # about a million characters at a time
                    held.append(t[at:at + (1 << 20)])
                    size += len(held[-1])
                    if size >= 1 << 20:
                        total += count_grams(" ".join(held))
                        held, size = [], 0
        total += count_grams(" ".join(held))
        cell = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cell, "n": total[cell]})

    texts = df.select(F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    grams = (texts.mapInPandas(count, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(1 << 20, "float64")
    counts[grams["cell"].to_numpy("int64")] = grams["n"].to_numpy("float64")
    return log_model(counts)


def _features(words: list[str], memo: _Memo) -> list[float]:
    """Marks in a text: the strongest weight, the logarithm of their number, the logarithm of
    the number of words (chance marks come with length)."""
    hits = [w for w in map(memo.__getitem__, words) if w > 0]
    return [max(hits, default=0.0), math.log1p(len(hits)), math.log1p(len(words))]


def _weigh(weights: dict[str, float]) -> _Memo:
    return _Memo(lambda w: max((weights.get(m, 0.0) for m in marks_of(w)), default=0.0))


def fit(df: DataFrame, labels: DataFrame, log_p: np.ndarray, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", sample_rows: int = 20_000,
        least_rows: int = 8, most_clean: float = 0.1) -> dict:
    """Weights of marks and the logistic function, from at most ``sample_rows`` labelled rows
    (the smallest by hash of id; an id labelled twice counts as 1 if either label is).

    A mark has to stand in ``least_rows`` different texts of label 1, and in clean texts at
    most ``most_clean`` times as often. Without any row of label 1 every score is 0.
    """
    spark = df.sparkSession
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows))
    # broadcast: sample_rows rows of two numbers at most; equal texts once
    sample = materialize(
        df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
        .join(F.broadcast(chosen), "_id").groupBy(F.xxhash64("_t").alias("h"))
        .agg(F.max("y").alias("y"), F.first("_t").alias("_t")), "sample")
    model_p = spark.sparkContext.broadcast(log_p)
    finding = F.pmod("h", F.lit(10)) < 7             # the rest fits the logistic function

    def marks(wanted):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader, n = Reader(model_p.value), Counter()
            keep = wanted.value if wanted else None
            for b in batches:
                for t in b["_t"]:
                    found = {m for w in set(reader.words(t)) for m in marks_of(w)}
                    n.update(found if keep is None else found & keep)
            if n:
                yield pd.DataFrame({"mark": list(n), "n": list(n.values())})
        return run

    def counted(y: int, wanted=None) -> dict[str, int]:
        got = (sample.filter(finding & (F.col("y") == y)).select("_t")
               .mapInPandas(marks(wanted), "mark string, n long")
               .groupBy("mark").agg(F.sum("n").alias("n")))
        got = got.filter(F.col("n") >= least_rows) if wanted is None else got
        return {r["mark"]: r["n"] for r in got.collect()}    # bounded by the sample

    size = {r["y"]: r["count"] for r in sample.filter(finding).groupBy("y").count().collect()}
    bad = counted(1)
    clean = counted(0, spark.sparkContext.broadcast(frozenset(bad)))
    n1, n0 = size.get(1, 0), size.get(0, 0)
    weights = {m: math.log((n + 0.5) / (n1 + 1)) - math.log((clean.get(m, 0) + 0.5) / (n0 + 1))
               for m, n in bad.items()
               if clean.get(m, 0) / max(n0, 1) <= most_clean * n / max(n1, 1)}
    shared = spark.sparkContext.broadcast(weights)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, weigh = Reader(model_p.value), _weigh(shared.value)
        for b in batches:
            rows = [(*_features(reader.words(t), weigh), y)
                    for t, y in zip(b["_t"], b["y"])]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "y"])

    x = (sample.filter(~finding).select("_t", "y")
         .mapInPandas(vectors, "a double, b double, c double, y int").toPandas())
    return {"weights": weights, "beta": _logistic(x[["a", "b", "c"]].to_numpy("float64"),
                                                   x["y"].to_numpy("float64"))}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Coefficients and constant of a logistic regression, by Newton's method."""
    if not len(y) or not y.any():
        return np.array([0.0] * x.shape[1] + [-50.0])
    x = np.column_stack([x, np.ones(len(x))])
    beta, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ beta)
        beta = beta + step
        if abs(step).max() < 1e-8:
            break
    return beta


def score(df: DataFrame, log_p: np.ndarray, model: dict, id_col: str = "doc_id",
          text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``id_col, score, predicted, n_marks`` (and ``restored`` with ``with_text``) of every row.

    ``score`` is 0 to 1, ``predicted`` 1 from 0.5 on. Null text counts as empty; an empty text
    has the score of a text without marks. Texts are read whole. Rows that repeat an id stay
    separate rows; other columns are ignored; an empty table gives an empty table.
    """
    shared = df.sparkSession.sparkContext.broadcast((log_p, model))

    @F.pandas_udf("score double, n_marks long" + (", restored string" if with_text else ""))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p, fitted = shared.value
        reader, weigh, beta = Reader(p), _weigh(fitted["weights"]), fitted["beta"]
        for texts in batches:
            rows = []
            for t in texts:
                words = reader.words(t)
                v = _features(words, weigh)
                z = min(30.0, max(-30.0, float(np.dot(v, beta[:3]) + beta[3])))
                rows.append((1 / (1 + math.exp(-z)), round(math.expm1(v[1]))) +
                            ((" ".join(words),) if with_text else ()))
            yield pd.DataFrame(rows, columns=["score", "n_marks"] + ["restored"] * with_text)

    out = df.select(F.col(id_col), run(F.col(text_col)).alias("_s"))
    extra = [F.col("_s.restored")] if with_text else []
    return out.select(id_col, F.col("_s.score"), (F.col("_s.score") >= 0.5).cast("int").alias("predicted"),
                      F.col("_s.n_marks"), *extra)
