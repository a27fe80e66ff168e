"""Exact quantiles and ranks by ranges: against numpy, with hot groups, ties, null keys and values; plan shape."""

import random

import numpy as np
import pytest

from mercato.operators import clean
from mercato.operators.ranges import join_groups, quantiles, value_counts

PROBS = [0.0, 0.05, 0.25, 0.5, 0.9, 0.975, 1.0]


def rows(seed, n=4000):
    r = random.Random(seed)
    out = [(r.choice(["hot"] * 6 + ["a", "b", None]), r.choice([1, 1, 2, None]), r.choice([round(r.gauss(0, 50), 2), 7.0, None]))
           for _ in range(n)]
    return out + [("single", 1, 3.5), ("none", 2, None)]


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_group_quantiles_match_numpy(spark, ranges):
    data = rows(ranges)
    df = spark.createDataFrame(data, "g string, h int, v double").repartition(5)
    got = {(r["g"], r["h"]): r["_q"] for r in quantiles(df, "v", PROBS, ["g", "h"], ranges).collect()}
    groups = {}
    for g, h, v in data:
        if v is not None:
            groups.setdefault((g, h), []).append(v)
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k] == pytest.approx(list(np.quantile(v, PROBS)), abs=1e-9)


def test_whole_frame_empty_and_weights(spark):
    data = rows(9)
    df = spark.createDataFrame(data, "g string, h int, v double")
    values = [v for *_, v in data if v is not None]
    assert quantiles(df, "v", PROBS).first()["_q"] == pytest.approx(list(np.quantile(values, PROBS)), abs=1e-9)
    assert quantiles(df.filter("false"), "v", PROBS).count() == 0
    counted = df.groupBy("v").count()
    assert quantiles(counted, "v", PROBS, weight="count").first()["_q"] == quantiles(df, "v", PROBS).first()["_q"]


def test_hot_group_spans_ranges(spark):
    df = spark.range(20000).selectExpr("if(id % 10 < 8, 'hot', 'cold') g", "id * 7919 % 100003 v")
    per = {r["_r"]: r["count"] for r in value_counts(df, "v", ["g"], 8).groupBy("_r").count().collect()}
    assert len(per) == 8 and max(per.values()) < 2 * 20000 / 8
    hot = value_counts(df, "v", ["g"], 8).filter("_g.k0 = 'hot'").select("_r").distinct().count()
    assert hot >= 6


def test_join_groups_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "g string, x int")
    stats = spark.createDataFrame([(None, 10), ("a", 20)], "g string, y int")
    assert sorted(map(repr, (tuple(r) for r in join_groups(df, stats, ["g"]).collect()))) == sorted(
        map(repr, [(None, 1, 10), ("a", 2, 20), ("b", 3, None)]))


def test_trims_shuffle_no_rows_and_use_no_percentile(spark):
    df = spark.createDataFrame(rows(4), "g string, h int, v double")
    for out in (clean.quantile_trim(df, "v", 0.05, 0.9, ["g"]), clean.median_impute(df, "v", ["g", "h"]),
                clean.two_stage_trim(df, ["g"], ["v"], 0.99, "v", 0.025)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan and "median" not in plan
        assert "hashpartitioning(g" not in plan  # the rows stay where they are read


def test_ranks_within_groups(spark):
    data = [(g, i) for i, g in enumerate(["hot"] * 300 + ["a"] * 20 + [None] * 5)]
    df = spark.createDataFrame(data, "g string, id long").repartition(4)
    got = clean.hash_rank_within(df, "g", "id", seed=1).collect()
    for g, n in (("hot", 300), ("a", 20), (None, 5)):
        assert sorted(r["hash_rank"] for r in got if r["g"] == g) == list(range(1, n + 1))
        assert {r["group_size"] for r in got if r["g"] == g} == {n}
