"""Descriptive statistics: single-pass aggregates, and exact quantiles looked up in ranges (``ranges``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.ranges import join_groups, quantiles
from mercato.operators.relational import money_avg


def skewness_corrected(c: str) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``skew``); Spark's
    ``skewness`` is the population g1."""
    n = F.count(c).cast("double")
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def describe_numeric(df: DataFrame, col: str, by: Sequence[str] = (), money: bool = True) -> DataFrame:
    """count, mean, std, min, q25, q50, q75, max per group in one aggregate."""
    mean = money_avg(col) if money else F.round(F.avg(col), 4)
    g = df.groupBy(*by).agg(
        F.count(col).alias("count"), mean.alias("mean"), F.round(F.stddev_samp(col), 4).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"))
    return join_groups(g, quantiles(df, col, [0.25, 0.5, 0.75], by), by).select(
        *by, "count", "mean", "std", "min", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "max")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe(include=object)``: count, unique, top (ties -> smallest), freq.
    Two aggregates over (variable, value) counts; no row leaves its task."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "variable", "value")
    counts = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy("variable").agg(
        F.sum("c").cast("bigint").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("top"),
        F.max("c").alias("freq"))


def fixed_bins(df: DataFrame, col: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram with ``n`` bins over [min, max]; the maximum falls
    in bin ``n`` (``width_bucket`` would put it in ``n + 1``)."""
    if by:
        bounds = df.groupBy(*by).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
        x = join_groups(df, bounds, by)
    else:
        x = df.withColumn("lo", df.select(F.min(col)).scalar()).withColumn(
            "hi", df.select(F.max(col)).scalar())
    lo, hi = F.col("lo"), F.col("hi")
    b = F.least(F.floor((F.col(col) - lo) / (hi - lo) * n).cast("int") + 1, F.lit(n))
    g = x.select(*by, b.alias("bin"), "lo", "hi").groupBy(*by, "bin", "lo", "hi").agg(
        F.count(F.lit(1)).alias("n"))
    return g.select(*by, "bin", "n", F.round(lo + (F.col("bin") - 1) * (hi - lo) / n, 4).alias("bin_lo"),
                    F.round(lo + F.col("bin") * (hi - lo) / n, 4).alias("bin_hi"))


def box_whiskers(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, IQR, whiskers (extreme points inside 1.5 IQR fences) and outlier count."""
    q = quantiles(df, col, [0.25, 0.5, 0.75], by).select(
        *by, *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "med", "q3"))])
    # whiskers and outliers depend on a row's group and value alone, so counted values stand for the rows
    x = join_groups(df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n")), q, by)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v = F.col(col)
    return x.groupBy(*by, "q1", "med", "q3").agg(
        F.min(F.when(v >= lo_f, v)).alias("lower_whisker"),
        F.max(F.when(v <= hi_f, v)).alias("upper_whisker"),
        F.sum(F.when((v < lo_f) | (v > hi_f), F.col("_n")).otherwise(0)).alias("n_outliers")).select(
        *by, F.round("q1", 4).alias("q1"), F.round("med", 4).alias("median"), F.round("q3", 4).alias("q3"),
        F.round(F.col("q3") - F.col("q1"), 4).alias("iqr"), "lower_whisker", "upper_whisker", "n_outliers")
