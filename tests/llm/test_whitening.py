"""Operator 11 against numpy on exact integers."""

import math

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from gleanspark.llm import queries, whitening
from tests.llm.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, _x int, _v int, whitened int"


def _frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vectors], SCHEMA)


def brute(vectors, components):
    """(integer rows, covariance, whitened columns up to sign) with Python integers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    apart = [[n * r[k] - s[k] for k in range(d)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in apart) / n**3 for j in range(d)] for i in range(d)])
    e, a = np.linalg.eigh(cov)
    top = np.argsort(-e)[:components]
    white = (np.array(apart, dtype=float) / n) @ a[:, top] / np.sqrt(e[top])
    return [sum(c * c for c in r) for r in apart], cov, e[top], white


def test_query_equals_brute_force(spark):
    got = queries.op11_whitening(spark, SF).toPandas()
    pdf = ds.dataset(f"{SF}/embeddings.parquet").to_table().to_pandas().sort_values("vec_id")
    deviation, cov, e, white = brute(pdf["embedding"].tolist(), 32)
    assert len(got) == len(pdf) * 32 and got["component"].max() == 32
    assert set(got["n"]) == {len(pdf)} and got["identity_error"].max() < 1e-10
    one = got[got["component"] == 1].sort_values("vec_id")
    assert one["deviation"].tolist() == deviation and one["deviation"].dtype == "int64"
    for k in range(32):
        mine = got[got["component"] == k + 1].sort_values("vec_id")
        assert mine["explained"].iloc[0] == pytest.approx(e[k] / np.trace(cov), rel=1e-9)
        w = mine["whitened"].to_numpy()
        sign = np.sign(w @ white[:, k])
        assert np.abs(w * sign - white[:, k]).max() < 1e-7


def test_planes_give_exact_products(spark):
    """Wide ranges of integers: sums beyond doubles, in any partitioning."""
    rnd = np.random.default_rng(5)
    x = np.column_stack([rnd.integers(-2**40, 2**40, 200), rnd.integers(0, 3, 200), np.full(200, 7),
                         rnd.integers(-5, 5, 200) + 2**50])
    frame = spark.createDataFrame([(r.tolist(),) for r in x], "_x array<long>").repartition(5)
    low, high = x.min(axis=0).tolist(), x.max(axis=0).tolist()
    sums, dots = whitening.cross_products(frame, low, high)
    y = [[int(v) - lo for v, lo in zip(r, low)] for r in x]
    assert sums == [sum(r[i] for r in y) for i in range(4)]
    assert dots == [[sum(r[i] * r[j] for r in y) for j in range(4)] for i in range(4)]


def test_unusable_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [0.5, -2.0, 3.0]), (2, None), (3, [1.0, None, 2.0]),
            (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [-inf, 1.0, 1.0]), (7, []), (8, [1.0]),
            (9, [4.0, 0.25, 3.0]), (10, [2.0, 7.0, 3.0])]
    out, model, error = whitening.whiten(_frame(spark, rows))
    got = out.collect()
    assert out.columns == ["vec_id", "deviation", "whitened"] and model.n == 5 and model.dims == 3
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "10", "9", "None"]
    assert all(r.whitened[2] is None and None not in r.whitened[:2] for r in got)       # constant dimension
    assert error < 1e-10
    good = [v for i, v in rows if i in (1, None, 9, 10)]
    deviation, _, _, white = brute([v[:2] for v in good], 2)
    assert sorted(r.deviation for r in got) == sorted(deviation)
    for k in range(2):
        assert sorted(abs(r.whitened[k]) for r in got) == pytest.approx(sorted(abs(white[:, k])), abs=1e-9)


def test_one_row_empty_table_and_empty_vectors(spark):
    out, model, error = whitening.whiten(_frame(spark, [(1, [1.0, 2.0])]))
    assert [(r.deviation, r.whitened) for r in out.collect()] == [(0, [None, None])] and error == 0.0
    for rows in ([], [(1, None)], [(1, []), (2, [])]):
        out, model, error = whitening.whiten(_frame(spark, rows))
        assert out.collect() == [] and model is None and out.columns == ["vec_id", "deviation", "whitened"]


def test_long_deviation_becomes_decimal(spark):
    rows = [(i, [float(v)]) for i, v in enumerate((2.0**50, -(2.0**50), 0.0))]
    out, _, _ = whitening.whiten(_frame(spark, rows))
    x = [int(v[0]) * 64 + 1_000_000 for _, v in rows]
    want = [(3 * v - sum(x)) ** 2 for v in x]
    assert [int(r.deviation) for r in out.orderBy("vec_id").collect()] == want
    with pytest.raises(Exception):           # an integer beyond a long is an error, not another number
        whitening.whiten(_frame(spark, [(1, [3e38]), (2, [1.0])]))[0].collect()


def test_partitioning_changes_nothing_exact(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet")
    a, m, _ = whitening.whiten(t.repartition(7))
    b, k, _ = whitening.whiten(t.coalesce(1))
    assert m.sums == k.sums and np.array_equal(m.eigenvalues, k.eigenvalues) and np.array_equal(m.vectors, k.vectors)
    assert a.select("vec_id", "deviation").exceptAll(b.select("vec_id", "deviation")).count() == 0
    assert a.agg(F.count("*")).first()[0] == 500
