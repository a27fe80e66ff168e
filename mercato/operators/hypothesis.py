"""Hypothesis tests: statistics are Spark aggregates; the final p-value is a
scalar function of a handful of numbers, evaluated in an Arrow UDF."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.ranking import rank_table


def _gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(500):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


@F.pandas_udf(T.DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_gammaincc(d / 2.0, s / 2.0) if s == s else float("nan") for s, d in zip(stat, dof)])


_erf = np.vectorize(math.erf, otypes=[float])


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + _erf(x / math.sqrt(2.0)))


def _range_cdf(q: np.ndarray, k: int) -> np.ndarray:
    """P(range of k iid N(0,1) <= q) for each q, by Gauss-Legendre over the smallest."""
    x, w = np.polynomial.legendre.leggauss(96)
    z, w = 8.0 * x, 8.0 * w
    phi = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    gap = np.clip(_normal(z[None, :] + q[:, None]) - _normal(z)[None, :], 0.0, 1.0)
    return np.clip(k * (w * phi * gap ** (k - 1)).sum(axis=1), 0.0, 1.0)


def studentized_range_cdf(q: float, k: int, df: float) -> float:
    """P(range / s <= q) with s^2 a mean square of ``df`` degrees of freedom: the range's distribution averaged over
    s = sqrt(chi2 / df), whose density is integrated around its mode."""
    if q <= 0:
        return 0.0
    if not math.isfinite(df) or df > 1e6:
        return float(_range_cdf(np.array([q]), k)[0])
    x, w = np.polynomial.legendre.leggauss(96)
    wide = min(12.0 / math.sqrt(2.0 * df), 6.0)
    lo, hi = max(0.0, 1.0 - wide), 1.0 + wide
    s, w = (hi - lo) / 2 * x + (hi + lo) / 2, (hi - lo) / 2 * w
    log_density = math.log(2.0) + df / 2 * math.log(df / 2) - math.lgamma(df / 2) + (df - 1) * np.log(s) - df * s * s / 2
    return float(min(1.0, (w * np.exp(log_density) * _range_cdf(q * s, k)).sum()))


def _range_quantile(p: float, k: int, df: float) -> float:
    """The q with P(range / s <= q) = p, by bisection."""
    lo, hi = 0.0, 8.0
    while studentized_range_cdf(hi, k, df) < p and hi < 1e6:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if studentized_range_cdf(mid, k, df) < p else (lo, mid)
    return (lo + hi) / 2


@F.pandas_udf(T.DoubleType())
def studentized_range_sf(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([max(0.0, 1.0 - studentized_range_cdf(float(a), int(b), float(c))) for a, b, c in zip(q, k, df)])


@F.pandas_udf(T.DoubleType())
def studentized_range_quantile(p: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    known: dict[tuple, float] = {}
    return pd.Series([known.setdefault(x, known.get(x) or _range_quantile(*x)) for x in (
        (float(a), int(b), float(c)) for a, b, c in zip(p, k, df))])


@F.pandas_udf(T.DoubleType())
def normal_ppf(p: pd.Series) -> pd.Series:
    nd = NormalDist()
    return p.map(lambda v: nd.inv_cdf(v) if 0 < v < 1 else float("nan"))


# Abramowitz-Stegun 7.1.26 coefficients (|error| < 1.5e-7).
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf(x: Column) -> Column:
    """Standard normal CDF from the A&S erf approximation, as a JVM expression."""
    z = F.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + AS_P * z)
    poly = t * (AS_A[0] + t * (AS_A[1] + t * (AS_A[2] + t * (AS_A[3] + t * AS_A[4]))))
    erf = 1.0 - poly * F.exp(-z * z)
    return F.when(x >= 0, 0.5 * (1.0 + erf)).otherwise(0.5 * (1.0 - erf))


def normal_cdf_sql(x: str) -> str:
    z = f"(abs({x}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + {AS_P} * {z}))"
    a = AS_A
    poly = f"({t} * ({a[0]} + {t} * ({a[1]} + {t} * ({a[2]} + {t} * ({a[3]} + {t} * {a[4]})))))"
    erf = f"(1.0 - {poly} * exp(-{z} * {z}))"
    return f"(CASE WHEN {x} >= 0 THEN 0.5 * (1.0 + {erf}) ELSE 0.5 * (1.0 - {erf}) END)"


def kruskal_wallis(df: DataFrame, group: str, col: str) -> DataFrame:
    """H statistic with tie correction, degrees of freedom and N."""
    # One pass over the rows: (group, value) counts, written once to the shared
    # checkpoint folder; ranks, group sums and tie terms are derived from it.
    from mercato.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    gv = df.groupBy(group, col).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    ranks = rank_table(gv, col, weight="n").select(col, "avg_rank", "c")
    r = gv.join(ranks.select(col, "avg_rank"), col).groupBy(group).agg(
        F.sum(F.col("n") * F.col("avg_rank")).alias("R"), F.sum("n").alias("ng"))
    s = r.agg(F.sum(F.col("R") * F.col("R") / F.col("ng")).alias("srn"), F.sum("ng").alias("N"),
              F.count(F.lit(1)).alias("k"))
    # Tie term from per-value counts (no need to re-run the rank table).
    per_value = gv.groupBy(col).agg(F.sum("n").cast("double").alias("c"))
    tt = per_value.agg(F.sum(F.col("c") * F.col("c") * F.col("c") - F.col("c"))).scalar()
    x = s.withColumn("tt", tt)
    N = F.col("N").cast("double")
    h = 12.0 / (N * (N + 1)) * F.col("srn") - 3 * (N + 1)
    corr = 1 - F.col("tt") / (N * N * N - N)
    return x.select((h / corr).alias("H"), (F.col("k") - 1).cast("int").alias("dof"), F.col("N").alias("n"))


#: Groups compared pair by pair.
MOST_GROUPS = 1000


def tukey_pairs(df: DataFrame, group: str, col: str) -> DataFrame:
    """Pairwise mean differences with the studentised statistic q.  Group
    statistics (k rows) are gathered into one array and paired by generators."""
    g = df.groupBy(group).agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.var_samp(col).alias("var"))
    if len(g.select(group).take(MOST_GROUPS + 1)) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups would be compared pair by pair")
    pooled = g.agg(F.sort_array(F.collect_list(F.struct(group, "n", "mean", "var"))).alias("gs"),
                   (F.sum((F.col("n") - 1) * F.col("var")) / (F.sum("n") - F.count(F.lit(1)))).alias("mse"),
                   F.count(F.lit(1)).alias("k"), (F.sum("n") - F.count(F.lit(1))).cast("double").alias("df"))
    a = pooled.select("mse", "k", "df", F.posexplode("gs").alias("i", "a"), "gs")
    b = a.select("mse", "k", "df", "i", "a", F.posexplode("gs").alias("j", "b")).filter(F.col("i") < F.col("j"))
    diff = F.col("b.mean") - F.col("a.mean")
    se = F.sqrt(F.col("mse") / 2.0 * (1.0 / F.col("a.n") + 1.0 / F.col("b.n")))
    return b.select(F.col(f"a.{group}").alias("group1"), F.col(f"b.{group}").alias("group2"),
                    diff.alias("meandiff"), (F.abs(diff) / se).alias("q"), "k", "df", se.alias("se"))


def ks_statistic(df: DataFrame, col: str) -> DataFrame:
    """One-sample KS D of the standardised column against N(0, 1)."""
    s = df.agg(F.avg(col).alias("mu"), F.stddev_samp(col).alias("sd"), F.count(col).alias("n"))
    z = df.select(((F.col(col) - s.select("mu").scalar()) / s.select("sd").scalar()).alias("z"))
    r = rank_table(z, "z")
    n = s.select("n").scalar().cast("double")
    cdf = normal_cdf(F.col("z"))
    d = F.greatest((F.col("below") + F.col("c")) / n - cdf, cdf - F.col("below") / n)
    return r.agg(F.max(d).alias("D"), F.first(n).alias("n"))
