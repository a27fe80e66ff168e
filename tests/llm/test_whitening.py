"""Whitening against an eigendecomposition of the whole matrix, and its defined cases."""

import math

import numpy as np
import pytest

from mercato.llm import whitening


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, component int").repartition(3)


def brute(vectors):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], dtype=object)
    n = len(x)
    s = x.sum(axis=0)
    a = np.array(n * x - s, dtype=float) / n
    e, v = np.linalg.eigh(a.T @ a / n)
    return n, [sum(int(t) ** 2 for t in row) for row in n * x - s], a, e[::-1], v[:, ::-1].T


def test_against_eigh(spark):
    r = np.random.default_rng(3)
    scales = np.array([3, 2, 1.4, 1, 0.7, 0.5, 0.35, 0.2, 0.1, 0.05])
    vectors = (r.normal(size=(400, 10)) * scales) @ np.linalg.qr(r.normal(size=(10, 10)))[0] + 5
    vectors[200:260] = vectors[7]
    out = whitening.whiten(frame(spark, [(i, v.tolist(), "x", 1) for i, v in enumerate(vectors)]))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    assert len(rows) == 400 * 8 and len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    n, deviation, a, e, v = brute(vectors)
    got = np.zeros((400, 8))
    for row in rows:
        got[row["vec_id"], row["component"] - 1] = row["whitened"]
        assert row["n"] == n and row["deviation"] == deviation[row["vec_id"]]
        assert row["explained"] == pytest.approx(e[row["component"] - 1] / e.sum(), rel=1e-10)
    for k in range(8):
        want = a @ v[k] / math.sqrt(e[k])
        want = want if want @ got[:, k] > 0 else -want
        assert np.abs(want - got[:, k]).max() < 1e-9


def test_dependent_and_badly_scaled_dimensions(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(60, 3)) * [1000.0, 1.0, 0.02]
    vectors = np.hstack([base, base[:, :1], np.zeros((60, 1))])  # a copy of a dimension and a constant one
    rows = whitening.whiten(frame(spark, [(i, v.tolist(), "x", 1) for i, v in enumerate(vectors)])).collect()
    _, _, a, e, v = brute(vectors)
    by = {(x["vec_id"], x["component"]): x for x in rows}
    assert len(rows) == 60 * 5
    for k in range(3):
        want = a @ v[k] / math.sqrt(e[k])
        got = np.array([by[i, k + 1]["whitened"] for i in range(60)])
        assert np.abs(np.abs(want) - np.abs(got)).max() < 1e-6
        assert by[0, k + 1]["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-6)
    assert all(by[i, k]["whitened"] is None and by[i, k]["explained"] == 0 for i in range(60) for k in (4, 5))
    assert rows[0]["identity_error"] < 1e-6


def test_dropped_rows_and_small_tables(spark):
    nan = float("nan")
    fine = [(1, [0.5, 1.0], None, None), (1, [0.5, 1.0], None, None), (None, [1.5, -1.0], None, None), (4, [2.0, 0.0], None, None)]
    bad = [(5, None, None, None), (6, [nan, 1.0], None, None), (7, [1.0, None], None, None), (8, [float("inf"), 0.0], None, None),
           (9, [], None, None), (10, [1.0, 2.0, 3.0], None, None)]
    rows = whitening.whiten(frame(spark, fine + bad)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"], r["component"]) for r in rows if r["vec_id"]) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 4, 1), (False, 4, 2)]
    assert len(rows) == 8 and {r["n"] for r in rows} == {4}
    assert whitening.whiten(frame(spark, [])).count() == 0 and whitening.whiten(frame(spark, bad[:2])).count() == 0
    alone = whitening.whiten(frame(spark, fine[:1])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(0, None, None, None)] * 2


def test_exact_sums_of_large_entries(spark):
    vectors = [[2.0**29, 1.0], [-(2.0**29), 0.0], [0.0, 3.0]]
    rows = whitening.whiten(frame(spark, [(i, v, "x", 1) for i, v in enumerate(vectors)])).collect()
    _, deviation, *_ = brute(vectors)
    assert deviation[0] > 2**63 and {(r["vec_id"], r["deviation"]) for r in rows} == {
        (i, t if t < 2**63 else None) for i, t in enumerate(deviation)}
