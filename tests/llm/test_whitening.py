"""Whitening against plain whole numbers and numpy."""

from __future__ import annotations

from fractions import Fraction

import duckdb
import numpy as np
import pytest

from termloom.llm import whitening as W
from termloom.llm.queries import op13_polarisation_whitening

SF = "/root/testdata/sf0.001"


def plain(vectors, most):
    """(n, deviations, covariance by products, eigenvalues, directions) of lists of numbers."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    y = [[n * row[d] - sums[d] for d in range(dims)] for row in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(dims)] for i in range(dims)])
    values, directions = np.linalg.eigh(v)
    return n, [sum(a * a for a in r) for r in y], v, values[::-1][:most], directions[:, ::-1][:, :most], np.array(y, float) / n


def check(rows, vectors, ids, most):
    n, deviations, v, values, directions, y = plain(vectors, most)
    assert len(rows) == n * len(values)
    want = y @ directions / np.sqrt(values)
    by = {i: k for k, i in enumerate(ids)}
    got = np.zeros_like(want)
    for r in rows:
        k = by[r["vec_id"]]
        got[k, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[k]
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(v)) <= 1e-9
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got, want * signs, atol=1e-7)
    assert np.abs(np.cov(got.T, bias=True) - np.eye(len(values))).max() < 1e-9


def test_query(spark):
    rows = op13_polarisation_whitening(spark, SF).collect()
    given = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    check(rows, [v for _, v in given], [i for i, _ in given], 32)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    assert all(r["deviation"] == r["exact_deviation"] for r in rows)


def test_hard_rows(spark):
    good = [(i, [float(np.sin(i * d + d)) * 3 for d in range(1, 5)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan"), 1.0, 1.0, 1.0]), (103, [1.0, float("-inf"), 1.0, 1.0]), (104, [])]
    rows = [(i, v, "x", 1) for i, v in [*good, *bad, good[3]]] + [(None, [0.25, -0.25, 0.5, 1.0], None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, component long").repartition(5)
    model = W.fit(df, most=3)
    out = W.transform(df, model).collect()
    assert len(out) == 42 * 3 and {r["n"] for r in out} == {42}
    assert sum(r["vec_id"] == 3 for r in out) == 6 and sum(r["vec_id"] is None for r in out) == 3
    assert W.identity_error(df, model) < 1e-9
    once = [(i, v) for i, v in good if i != 3] + [(3, good[3][1]), (1003, good[3][1]), (2000, [0.25, -0.25, 0.5, 1.0])]
    renamed = {3: 3, None: 2000}
    check([{**r.asDict(), "vec_id": renamed.get(r["vec_id"], r["vec_id"])} for r in out] [:0] + _spread(out), [v for _, v in once], [i for i, _ in once], 3)


def _spread(out):
    """The repeated row under two ids, the null id under one."""
    seen, rows = {}, []
    for r in out:
        key = 2000 if r["vec_id"] is None else r["vec_id"]
        if key == 3:
            seen[r["component"]] = seen.get(r["component"], 0) + 1
            key = 1003 if seen[r["component"]] == 2 else 3
        rows.append({**r.asDict(), "vec_id": key})
    return rows


def test_without_variance(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert W.transform(none, W.fit(none)).count() == 0 and W.identity_error(none, W.fit(none)) == 0.0
    same = spark.createDataFrame([(i, [1.0, 2.0, float(i % 2)]) for i in range(6)], "vec_id long, embedding array<float>")
    model = W.fit(same)
    assert len(model.values) == 1 and W.transform(same, model).count() == 6
    one = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert W.transform(one, W.fit(one)).count() == 0
    with pytest.raises(Exception, match="different lengths"):
        W.fit(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>").coalesce(1))


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    for bits in (10, 25, 26, 40, 51, 61):
        x = rng.integers(-(1 << bits), 1 << bits, (2500, 3))
        assert W.sums_of_squares(x) == [sum(v * v for v in c) for c in x.T.tolist()]
    x = np.array([[1 << 50, 3], [7, 1 << 51]])
    assert W.centred(x, 10**6, [5, 9]).tolist() == [[10**6 * a - s for a, s in zip(r, (5, 9))] for r in x.tolist()]
    assert W.sums_of_squares(W.centred(x, 10**6, [5, 9]).astype(object)) == [sum(v * v for v in c) for c in W.centred(x, 10**6, [5, 9]).T.tolist()]
