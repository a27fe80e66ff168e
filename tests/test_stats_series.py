"""Statistics and series semantics (FIXTURES.md 3.8, 3.9, 3.11) and invariants."""

import math

import numpy as np
from pyspark.sql import functions as F

from mercato.operators.clean import median_impute, undersample
from mercato.operators.hypothesis import _gammaincc, kruskal_wallis
from mercato.operators.ml import dtw
from mercato.operators.ranking import rank_table
from mercato.operators.relational import latest_per_key
from mercato.operators.series import add_rolling, demand_classes, demand_gaps
from mercato.operators.stats import skewness_corrected


def test_stats_on_small_vector(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "x double")
    r = df.agg(F.median("x"), F.percentile("x", 0.05), F.stddev_samp("x"), F.skewness("x"),
               skewness_corrected("x")).first()
    assert r[0] == 3.0 and abs(r[1] - 1.2) < 1e-12
    assert abs(r[2] - 3.5355339059327378) < 1e-12
    assert abs(r[3] - 1.1384199576606164) < 1e-12 and abs(r[4] - 1.6970562748477143) < 1e-12


def test_median_imputation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("a", 4.0), ("a", 10.0)], "g string, x double")
    assert sorted(r.x for r in median_impute(df, "x", ["g"]).collect()) == [1.0, 2.0, 3.0, 4.0, 10.0]


def test_leak_free_rolling(spark):
    df = spark.createDataFrame([("k", i, float(i)) for i in range(1, 6)], "k string, t int, x double")
    out = [r["MA_x_2"] for r in add_rolling(df, "k", "t", "x", [2]).orderBy("t").collect()]
    assert out == [None, None, None, 2.0, 3.0]


def test_gaps_and_classes(spark):
    vals = [0, 0, 5, 0, 3, 0, 0, 2]
    rows = [("p", f"2024-01-0{i + 1}", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "product_id string, d string, qtt double").select(
        "product_id", F.to_date("d").alias("date"), "qtt")
    gaps = [r.gap for r in demand_gaps(df, "product_id", "date", "qtt").orderBy("date").collect()]
    assert gaps == [None, 2, 3]
    c = demand_classes(df, "product_id", "date", "qtt").first()
    assert c.adi == 2.5 and c.demand_class in ("Intermittent demand", "Lumpy demand")


def test_rank_table_matches_pandas(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 50, 400).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    r = {row.x: row.avg_rank for row in rank_table(df, "x", buckets=8).collect()}
    import pandas as pd
    ranks = pd.Series(vals).rank(method="average")
    for v, rk in zip(vals, ranks):
        assert abs(r[v] - rk) < 1e-9


def test_kruskal_wallis_known_value(spark):
    rows = [("a", 2.9), ("a", 3.0), ("a", 2.5), ("a", 2.6), ("a", 3.2), ("b", 3.8), ("b", 2.7), ("b", 4.0),
            ("b", 2.4), ("c", 2.8), ("c", 3.4), ("c", 3.7), ("c", 2.2), ("c", 2.0)]
    kw = kruskal_wallis(spark.createDataFrame(rows, "g string, x double"), "g", "x").first()
    assert abs(kw.H - 0.7714285714285722) < 1e-9 and kw.dof == 2
    assert abs(_gammaincc(1.0, 0.7714285714285722 / 2) - math.exp(-0.7714285714285722 / 2)) < 1e-12


def test_latest_per_key_is_order_free(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "x")], "k int, t int, v string")
    a = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["t"]).collect())
    b = sorted(tuple(r) for r in latest_per_key(df.repartition(3), ["k"], ["t"]).collect())
    assert a == b == [(1, 3, "c"), (2, 1, "x")]


def test_undersample_balances(spark):
    rows = [(i, 0 if i < 70 else 1) for i in range(100)]
    out = undersample(spark.createDataFrame(rows, "id long, y int").repartition(4), "y", "id")
    counts = dict(out.groupBy("y").count().collect())
    assert counts == {0: 30, 1: 30}


def test_dtw_basics():
    a = np.array([0.0, 1.0, 2.0, 3.0])
    assert dtw(a, a) == 0.0
    assert dtw(a, np.array([0.0, 0.0, 1.0, 2.0, 3.0])) == 0.0
    assert dtw(a, a + 1, band=1) > 0


def test_hash_rank_within_matches_window(spark):
    from pyspark.sql import Window
    from mercato.operators.clean import hash_rank_within
    rows = [(i, "a" if i % 3 else "b") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string").repartition(5)
    got = {r.id: (r.hash_rank, r.group_size) for r in hash_rank_within(df, "g", "id", seed=9).collect()}
    w = Window.partitionBy("g").orderBy(F.xxhash64("id", F.lit(9)), "id")
    ref = df.select("id", F.row_number().over(w).alias("rk"), F.count(F.lit(1)).over(Window.partitionBy("g"))
                    .alias("n")).collect()
    assert all(got[r.id] == (r.rk, r.n) for r in ref)


def test_spread_only_when_needed(spark):
    from mercato.operators.relational import spread
    one = spark.range(100).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert spread(many, 4).rdd.getNumPartitions() == 6


def test_baskets_of_some_assets(spark):
    """All baskets of the requested assets, whatever others are priced; too many assets are an error."""
    import pytest
    from mercato.operators.portfolio import basket_metrics
    rows = [(f"2024-01-{d:02d}", a, float(10 + d * (i + 1) % 7 + i * i)) for d in range(1, 29)
            for i, a in enumerate(["a", "b", "c", "d"])]
    prices = spark.createDataFrame(rows, "date string, asset string, price double")
    some = ["a", "c", "d"]
    got = basket_metrics(prices, some).collect()
    assert len(got) == 7
    med = {a: float(np.median([p for _, x, p in rows if x == a])) for a in some}
    for r in got:
        want = sum(med[a] for i, a in enumerate(some) if r["pid"] >> i & 1)
        assert abs(r["revenue"] - want) < 1e-4
    with pytest.raises(ValueError):
        basket_metrics(prices, [str(i) for i in range(17)])


def test_rank_table_invariant_to_buckets_and_partitioning(spark):
    rng = np.random.default_rng(1)
    vals = [(float(v), int(v) % 2) for v in rng.integers(0, 300, 2000)]
    df = spark.createDataFrame(vals, "x double, y int")
    a = sorted(tuple(r) for r in rank_table(df, "x", [("pos", F.col("y") == 1)], buckets=2).collect())
    b = sorted(tuple(r) for r in rank_table(df.repartition(7), "x", [("pos", F.col("y") == 1)], buckets=32)
               .collect())
    assert a == b


def test_running_max_before_matches_window(spark):
    from pyspark.sql import Window
    from mercato.operators.ordered import running_max_before
    rng = np.random.default_rng(2)
    rows = [(i, float(v)) for i, v in enumerate(rng.normal(size=1500))]
    df = spark.createDataFrame(rows, "id long, v double").repartition(5)
    got = {r.id: r.seen_max for r in running_max_before(df, "id", "v", buckets=16).collect()}
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    ref = {r.id: r.m for r in df.select("id", F.max("v").over(w).alias("m")).collect()}
    assert got == ref
