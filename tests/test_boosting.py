"""Boosted trees on codes against ``pyspark.ml`` on one-hot vectors, and Spark's draws."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from mercato.operators import boosting as B
from mercato.operators import ml as M

CATS, NUMS = ["a", "b"], ["x", "y", "z"]


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    data = []
    for i in range(12_000):
        a, b, x, y, z = r.choice("pqrst"), r.choice([None, "u", "v"]), float(r.randint(0, 59)), r.gauss(0, 1), r.choice([0.0, 2.0, None])
        data.append((i, a, b, x, y, z, 10 * (a == "q") + x * (b == "u") + 3 * y + 5 * (z or 1.0) + r.gauss(0, 1), i % 4))
    df = M.written(spark.createDataFrame(data, "id long, a string, b string, x double, y double, z double, label double, fold int").repartition(3))
    return M.onehot_pipeline(CATS, NUMS).fit(df).transform(df)


def own(train, maxBins, **kw):
    binned = B.Binned(train, [f"{c}_idx" for c in CATS], M.onehot_sizes(train, CATS), NUMS, "label", maxBins, 42)
    model = B.fit(binned, seed=42, **kw)
    binned.release()
    return model


@pytest.mark.parametrize("kw", [{"maxIter": 4, "maxDepth": 4, "maxBins": 64}, {"maxIter": 3, "maxDepth": 3, "maxBins": 16, "subsamplingRate": 0.7, "stepSize": 0.3}])
def test_trees_are_those_of_spark(spark, rows, kw):
    train = rows.filter("z is not null")  # Spark's trees and their cut points disagree on a missing number
    theirs = GBTRegressor(featuresCol="features", labelCol="label", seed=42, **kw).fit(train)
    ours = own(train, **kw)
    want = dict(theirs.transform(rows).select("id", "prediction").toPandas().values)
    got = dict(ours.transform(rows).select("id", "prediction").toPandas().values)
    assert len(got) == 12_000 and got == pytest.approx(want, rel=1e-9, abs=1e-7)
    assert ours.feature_importances == pytest.approx(theirs.featureImportances.toArray(), rel=1e-6, abs=1e-9)


def test_blocks_make_no_difference(spark, rows, monkeypatch):
    train = rows.filter("z is not null")
    whole = own(train, 64, maxIter=3, subsamplingRate=0.8)
    assert whole.transform(rows).filter("prediction is null or isnan(prediction)").count() == 0
    monkeypatch.setattr(B, "TASK_BLOCKS", 1)
    cut = own(train, 64, maxIter=3, subsamplingRate=0.8)
    assert [t.splits for t in cut.trees] == [[(n, f, pytest.approx(g)) for n, f, g in t.splits] for t in whole.trees]


def test_missing_values_are_errors_in_training(spark, rows):
    """As in ``pyspark.ml``."""
    train = rows.filter("z is not null")
    with pytest.raises(Exception, match="Labels MUST NOT be Null or NaN"):
        own(train.withColumn("label", F.when(F.col("id") % 50 != 7, F.col("label"))), 64, maxIter=1)
    with pytest.raises(Exception, match="Vector values MUST NOT be NaN"):
        own(rows, 64, maxIter=1)
    with pytest.raises(ValueError, match="rows"):
        own(rows.filter("false"), 64, maxIter=1)


def test_spark_draws(spark):
    jvm = spark._jvm.org.apache.spark.util.random
    for seed in (0, 42, -5):
        theirs = jvm.XORShiftRandom(seed)
        got = B.xorshift_doubles(seed, 50)
        assert got.tolist() == [theirs.nextDouble() for _ in range(50)]
    assert len(B.xorshift_doubles(3, 0)) == 0 and B.xorshift_doubles(3, 1000)[:50].tolist() == B.xorshift_doubles(3, 50).tolist()
    assert B.xorshift_doubles(3, 100, 17).tolist() == B.xorshift_doubles(3, 117)[17:].tolist()


def test_no_reader_holds_one_hot_vectors(spark, rows):
    """A row is its codes and its error: it was some 1.3 kB, one number a feature, in every pass."""
    train = rows.filter("z is not null")
    binned = B.Binned(train, ["a_idx", "b_idx"], M.onehot_sizes(rows, CATS), NUMS, "label", 64, 42)
    held = binned.blocks.agg(F.sum(F.length("codes") + F.length("error")), F.sum("rows")).first()
    binned.release()
    assert held[1] == train.count() and held[0] == held[1] * (5 + 8)


def test_places_come_sorted_once(spark):
    df = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "k long, v long").repartition(5)
    got = M.ranked(df, ["k"], "at")
    assert got.columns == ["k", "v", "at"] and all(r["k"] == r["at"] for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("Join")[0] and "row_number" not in plan  # places were found while writing


def test_even_files(spark):
    one = spark.range(0, 1000, 1, 1)
    assert M.even_files(one, rows=10).rdd.getNumPartitions() >= 2 and M.even_files(one, rows=10).count() == 1000
    assert M.even_files(one, rows=1000).rdd.getNumPartitions() == 1
    assert M.even_files(one.filter("false")).count() == 0
