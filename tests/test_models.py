"""Model and series operators on fixtures with a planted signal."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from mercato.operators import dtw as D
from mercato.operators import ml as M
from mercato.operators import series as S
from mercato.operators.hypothesis import _range_quantile, studentized_range_cdf


def plain_dtw(a, b, band):
    d = np.full((len(a) + 1, len(b) + 1), np.inf)
    d[0, 0] = 0
    for i in range(1, len(a) + 1):
        for j in range(max(1, i - band), min(len(b), i + band) + 1):
            d[i, j] = (a[i - 1] - b[j - 1]) ** 2 + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    return math.sqrt(d[-1, -1])


def shapes(n=60, length=24, seed=1):
    """Three shapes, shifted in time and with noise: (id, series, shape)."""
    r = random.Random(seed)
    t = np.arange(length)
    out = []
    for i in range(n):
        kind, shift = i % 3, r.randint(-2, 2)
        base = [np.where((t + shift) % length < 6, 3.0, 0.0), np.sin((t + shift) / length * 4 * math.pi) * 2, (t + shift) / length * 4 - 2][kind]
        out.append((i, [float(x + r.gauss(0, 0.1)) for x in base], kind))
    return out


def test_dtw_batch_bound_and_soft():
    r = np.random.default_rng(2)
    rows, other = r.normal(size=(20, 12)), r.normal(size=12)
    for band in (0, 2, 12):
        got = D.dtw_batch(rows, other, band)
        assert got == pytest.approx([plain_dtw(a, other, band) for a in rows])
        assert (D.keogh_bound(rows, other, band) <= got + 1e-9).all()
    hard = D.dtw_batch(rows, other, 12) ** 2
    assert D.dtw_batch(rows, other, 12, gamma=1e-4) == pytest.approx(hard, abs=0.05)
    assert (D.dtw_batch(rows, other, 12, gamma=1.0) < hard).all()
    medoids = r.normal(size=(4, 12))
    where, best, aligned = D.nearest(rows, medoids, 3)
    every = np.stack([D.dtw_batch(rows, m, 3) for m in medoids], axis=1)
    assert (where == every.argmin(axis=1)).all() and best == pytest.approx(every.min(axis=1)) and aligned <= every.size


def test_k_medoids_recover_three_shapes(spark):
    rows = shapes()
    df = spark.createDataFrame([(i, s) for i, s, _ in rows], "id long, s array<double>").repartition(4)
    got = {r["id"]: r["medoid"] for r in D.k_medoids(df, "id", "s", k=3, band=4).collect()}
    kinds = {}
    for i, _, kind in rows:
        kinds.setdefault(got[i], set()).add(kind)
    assert len(kinds) == 3 and all(len(k) == 1 for k in kinds.values())
    assert all(got[m] == m for m in kinds)
    assert D.k_medoids(df.filter("false"), "id", "s", 3, 4).count() == 0
    assert {r["distance"] for r in D.k_medoids(df.limit(2), "id", "s", 5, 4).collect()} == {0.0}


def daily(spark, series):
    start = dt.date(2020, 1, 1)
    return spark.createDataFrame([(k, start + dt.timedelta(days=i), float(x)) for k, xs in series.items() for i, x in enumerate(xs)],
                                 "name string, day date, x double")


def test_planted_breaks(spark):
    r = random.Random(3)
    step = [r.gauss(0, 1) + (0 if i < 100 else 8 if i < 170 else 3) for i in range(260)]
    flat = [r.gauss(5, 1) for _ in range(260)]
    df = daily(spark, {"step": step, "flat": flat, "short": [1.0, 2.0], "constant": [4.0] * 50})
    got = S.segment_breaks(df, "name", "day", "x").collect()
    start = dt.date(2020, 1, 1)
    days = sorted((row["day"] - start).days for row in got if row["name"] == "step")
    assert len(days) == 2 and abs(days[0] - 100) <= 1 and abs(days[1] - 170) <= 1 and {row["name"] for row in got} == {"step"}
    assert abs([row["mean_after"] for row in got if abs((row["day"] - start).days - 100) <= 1][0] - 8) < 0.5
    peaks = S.change_points(df, "name", "day", "x", 20).collect()
    assert {row["name"] for row in peaks} == {"step"} and sorted(abs((row["day"] - start).days) for row in peaks) == pytest.approx([100, 170], abs=2)


def test_partial_autocorrelation(spark):
    r = random.Random(4)
    x = [0.0, 0.0]
    for _ in range(600):
        x.append(0.5 * x[-1] + 0.3 * x[-2] + r.gauss(0, 1))
    df = daily(spark, {"ar2": x, "constant": [1.0] * 30})
    rows = {(row["name"], row["k"]): row["pacf"] for row in S.pacf(df, "name", "day", "x", 5).collect()}
    d = np.array(x) - np.mean(x)
    rho = [float((d[k:] * d[: len(d) - k]).sum() / (d * d).sum()) for k in range(6)]
    for k in range(1, 6):  # the last coefficient of the Yule-Walker equations of order k
        a = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
        assert rows["ar2", k] == pytest.approx(np.linalg.solve(a, np.array(rho[1 : k + 1]))[-1], abs=1e-5)
        assert rows["constant", k] is None
    assert abs(rows["ar2", 2] - 0.3) < 0.12 and abs(rows["ar2", 4]) < 0.12


def test_studentized_range_table_values():
    # 95 % points of the studentised range by groups and degrees of freedom.
    for k, df, q in [(2, 10, 3.151), (3, 10, 3.877), (4, 20, 3.958), (5, 20, 4.232), (10, 60, 4.646), (3, 5, 4.602), (4, float("inf"), 3.633)]:
        assert _range_quantile(0.95, k, df) == pytest.approx(q, abs=1e-3)
        assert studentized_range_cdf(q, k, df) == pytest.approx(0.95, abs=2e-4)
    assert studentized_range_cdf(0.0, 3, 10) == 0.0


def planted(spark, n=1500):
    r = random.Random(6)
    rows = []
    for i in range(n):
        a, b, c = r.gauss(0, 1), r.gauss(0, 1), r.gauss(0, 1)
        rows.append((i, a, b, c, 5 * a + b * (1 if a > 0 else -1) + r.gauss(0, 0.3), i % 5))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double, fold int").repartition(4)


def test_permutation_importance_finds_the_signal(spark):
    df = planted(spark).cache()
    p = M.permuted(df, "a", ["id"], 3)
    assert p.columns == df.columns and p.count() == df.count()
    assert sorted(x[0] for x in p.select("a").collect()) == sorted(x[0] for x in df.select("a").collect())
    assert p.select("id", F.col("a").alias("p")).join(df, "id").filter("p = a").count() < 30
    assert sorted(map(tuple, M.permuted(df.repartition(7), "a", ["id"], 3).collect())) == sorted(map(tuple, p.collect()))
    asm = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    m = GBTRegressor(maxIter=10, maxDepth=4, seed=1).fit(asm.transform(df.filter("fold <> 0")))
    found = dict(M.permutation_importance(df.filter("fold = 0"), ["a", "b", "c"], ["id"], lambda d: m.transform(asm.transform(d))))
    assert found["a"] > 3 * found["b"] > 0 and abs(found["c"]) < 0.1 * found["a"]


def test_successive_halving_beats_the_mean(spark):
    x = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(planted(spark)).select("features", "label", "fold").cache()
    draws = [{"maxDepth": d, "maxIter": i} for d in (1, 4) for i in (1, 8)]
    rows = M.successive_halving(x, draws, lambda t, d: GBTRegressor(seed=1, **d).fit(t),
                                lambda m, t: M.regression_report(m.transform(t)).first()["rmse"])
    assert [(r[0], r[2]) for r in rows] == [(0, 1)] * 4 + [(1, 2)] * 2 + [(2, 4)]
    assert draws[rows[-1][1]] == {"maxDepth": 4, "maxIter": 8}
    spread = x.filter("fold = 0").agg(F.stddev_pop("label")).first()[0]
    assert rows[-1][3] < 0.4 * spread


def test_even_parts_follow_the_rows(spark):
    one = spark.range(0, 1000, 1, 1).withColumn("x", F.col("id") % 7)
    got = M.even_parts(one, rows=100)
    assert got.rdd.getNumPartitions() == 10 and got.count() == 1000 and got.agg(F.sum("id")).first()[0] == 499500
    assert max(got.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 200
    assert M.even_parts(one, rows=1000).rdd.getNumPartitions() == 1
    assert M.even_parts(one.filter("false"), rows=10).count() == 0


def test_permutation_places_rows_once(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i), float(i % 3), float(2 * i)) for i in range(60)], "k long, a double, b double, label double")
    calls, whole = [], M.ranked
    monkeypatch.setattr(M, "ranked", lambda d, order, name: calls.append(name) or whole(d, order, name))
    got = dict(M.permutation_importance(df, ["a", "b"], ["k"], lambda d: d.withColumn("prediction", 2 * F.col("a"))))
    assert got["a"] > 1 and got["b"] == 0 and calls.count("_at") == 1 and calls.count("_to") == 2


def test_standard_series_match_the_calendar_join(spark):
    from mercato.operators.relational import reconcile
    day = lambda m: dt.date(1999 + (m - 1) // 12, (m - 1) % 12 + 1, 1)
    rows = [(1, day(3), 5.0), (1, day(14), 2.0), (2, day(1), 4.0), (2, day(16), None), (3, None, 7.0), (None, day(2), 3.0)]
    rows += [(4, day(m), 6.0) for m in range(1, 17)]
    df = spark.createDataFrame(rows, "k int, m date, v double")
    z = S.znorm(reconcile(df, ["k"], "m", ["v"], step="1 month", fill=0.0), "k", "v")
    want = {r["k"]: [x["z"] for x in r["s"]] for r in z.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("m", "z"))).alias("s")).collect()}
    got = {r["k"]: r["series"] for r in S.standard_series(df, "k", "m", "v").collect()}
    assert got.keys() == want.keys() == {1, 2, 3, 4} and len(got[1]) == 16
    assert all(got[k] == pytest.approx(want[k]) for k in want) and not any(got[3] + got[4])
    assert S.standard_series(df.filter("false"), "k", "m", "v").count() == 0
