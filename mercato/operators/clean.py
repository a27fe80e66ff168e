"""Cleaning operators: null profiles, imputation, quantile trims, outlier
rules, label maps, class balancing.

Group statistics are computed with aggregates and joined back on the group key
(no per-group windows over raw rows), so a hot group is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ranges import in_ranges, join_groups, quantile_scalars, quantiles, with_quantiles


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``isnull().sum()`` in one pass (NaN counts as missing for doubles)."""
    def missing(c):
        dtype = dict(df.dtypes)[c]
        cond = F.col(c).isNull() | F.isnan(c) if dtype in ("double", "float") else F.col(c).isNull()
        return F.sum(cond.cast("int")).cast("bigint").alias(c)
    return df.agg(*[missing(c) for c in cols])


def median_impute(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Fill nulls with the exact median of the row's group."""
    x = with_quantiles(df, col, [0.5], by)
    return x.withColumn(col, F.coalesce(F.col(col), F.get("_q", F.lit(0)))).drop("_q")


def quantile_trim(df: DataFrame, col: str, lo: float, hi: float, by: Sequence[str] = (),
                  inclusive: bool = True) -> DataFrame:
    """Keep rows inside the [q_lo, q_hi] range (strict when ``inclusive`` is False)."""
    if by:
        x = with_quantiles(df, col, [lo, hi], by).withColumn("_lo", F.get("_q", F.lit(0))).withColumn("_hi", F.get("_q", F.lit(1)))
    else:
        low, high = quantile_scalars(df, col, [lo, hi])
        x = df.withColumn("_lo", low).withColumn("_hi", high)
    v = F.col(col)
    cond = (v >= F.col("_lo")) & (v <= F.col("_hi")) if inclusive else (v > F.col("_lo")) & (v < F.col("_hi"))
    return x.filter(cond).select(*df.columns)


def two_stage_trim(df: DataFrame, by: Sequence[str], cols: Sequence[str], q_hi: float,
                   second_col: str, q_lo: float) -> DataFrame:
    """Stage 1: every column <= its group q_hi.  Stage 2: ``second_col`` > the
    group q_lo recomputed on the survivors."""
    # all columns in one pass: a value's column is part of its group
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(by), list(cols), "_c", "_x")
    q1 = quantiles(long, "_x", [q_hi], [*by, "_c"]).groupBy(*by).agg(*[
        F.max(F.when(F.col("_c") == c, F.get("_q", F.lit(0)))).alias(f"_h_{c}") for c in cols])
    s1 = join_groups(df, q1, by)
    for c in cols:
        s1 = s1.filter(F.col(c) <= F.col(f"_h_{c}"))
    s1 = s1.select(*df.columns)
    s2 = with_quantiles(s1, second_col, [q_lo], by)
    return s2.filter(F.col(second_col) > F.get("_q", F.lit(0))).select(*df.columns)


def zscore_counts(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Rows kept per group by |z| < 3, modified z (MAD) <= 3.5 and the IQR fences."""
    s = df.groupBy(*by).agg(F.avg(col).alias("mu"), F.stddev_samp(col).alias("sd"))
    q = join_groups(s, quantiles(df, col, [0.5, 0.25, 0.75], by), by).select(
        *by, "mu", "sd", F.get("_q", F.lit(0)).alias("med"), F.get("_q", F.lit(1)).alias("q1"), F.get("_q", F.lit(2)).alias("q3"))
    # every rule looks at a row's group and value alone: from here on counted values stand for the rows
    counted = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    d = join_groups(counted, q, by).withColumn("dev", F.abs(F.col(col) - F.col("med")))
    x = join_groups(d, quantiles(d, "dev", [0.5], by, weight="_n"), by).withColumn("mad", F.get("_q", F.lit(0)))
    v = F.col(col)
    iqr = F.col("q3") - F.col("q1")

    def kept(rule):
        return F.sum(F.when(rule, F.col("_n")).otherwise(0))

    return x.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        kept(F.abs((v - F.col("mu")) / F.col("sd")) < 3).alias("n_z_kept"),
        kept(F.abs(0.6745 * (v - F.col("med")) / F.col("mad")) <= 3.5).alias("n_mad_kept"),
        kept((v >= F.col("q1") - 1.5 * iqr) & (v <= F.col("q3") + 1.5 * iqr)).alias("n_iqr_kept"))


def safe_downcast_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Smallest integer type holding each column's [min, max] (one aggregate)."""
    row = df.agg(*[F.min(c).cast("bigint").alias(f"{c}__min") for c in cols],
                 *[F.max(c).cast("bigint").alias(f"{c}__max") for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("min_value"),
                                 F.col(f"{c}__max").alias("max_value")) for c in cols])
    x = row.select(F.inline(entries))
    lo, hi = F.col("min_value"), F.col("max_value")
    t = (F.when((lo >= -128) & (hi <= 127), "tinyint").when((lo >= -32768) & (hi <= 32767), "smallint")
         .when((lo >= -2147483648) & (hi <= 2147483647), "int").otherwise("bigint"))
    return x.withColumn("target_type", t)


def dense_label_map(df: DataFrame, col: str, out: str) -> DataFrame:
    """Sorted distinct values -> 0-based dense ids.  The ranking window runs over
    the distinct values only (a category domain), never over rows."""
    d = df.select(col).distinct()
    return d.select(col, (F.dense_rank().over(Window.orderBy(col)) - 1).cast("int").alias(out))


def density_keep_bins(df: DataFrame, col: str, n_bins: int, nu: float) -> DataFrame:
    """Novelty filter re-aimed: keep the densest equal-width bins until they
    cover (1 - nu) of the rows; the window runs over ``n_bins`` rows."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    n = df.select(F.count(F.lit(1))).scalar()
    b = F.least(F.floor((F.col(col) - lo) / (hi - lo) * n_bins).cast("int") + 1, F.lit(n_bins))
    c = df.select(b.alias("bin"), n.alias("n")).groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"),
                                                                 F.max("n").alias("n"))
    w = Window.orderBy(F.desc("cnt"), "bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("cnt").over(w), F.lit(0))
    return c.select("bin", "cnt", F.when(before < (1 - nu) * F.col("n"), 1).otherwise(0).alias("kept"))


def density_keep_rows(df: DataFrame, col: str, n_bins: int, nu: float) -> DataFrame:
    """The rows of ``df`` in the bins that ``density_keep_bins`` keeps, with their ``bin``; null values go."""
    lo, hi = df.select(F.min(col)).scalar(), df.select(F.max(col)).scalar()
    kept = density_keep_bins(df.filter(F.col(col).isNotNull()), col, n_bins, nu).filter("kept = 1").select("bin")
    binned = df.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("bin", F.least(F.floor(
        (F.col(col) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * n_bins).cast("int") + 1, F.lit(n_bins))).drop("_lo", "_hi")
    return binned.join(F.broadcast(kept), "bin", "left_semi")  # at most n_bins rows


def hash_rank_within(df: DataFrame, group: str, key: str, seed: int = 42) -> DataFrame:
    """Exact 1-based rank of each row inside its group by a seeded key hash, plus the group size.

    Rows are dealt into ranges of (group, hash, key) and numbered per range; a table of one row per group and range
    shifts them, so a group holding a third of the data is never ranked in one task."""
    x = in_ranges(df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), [group, "_h", key])
    sizes = x.groupBy(group, "_r").agg(F.count(F.lit(1)).alias("_n"))
    ow = Window.partitionBy(group).orderBy("_r")
    off = sizes.select(F.col(group).alias("_of"), F.col("_r").alias("_at"), F.coalesce(F.sum("_n").over(
        ow.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(group)).alias("group_size"))
    local = F.row_number().over(Window.partitionBy(group, "_r").orderBy("_h", key))
    return (x.withColumn("_local", local).join(off, F.col(group).eqNullSafe(F.col("_of")) & (F.col("_r") == F.col("_at")))
            .withColumn("hash_rank", F.col("_off") + F.col("_local")).select(*df.columns, "group_size", "hash_rank"))


def undersample(df: DataFrame, cls: str, key: str, seed: int = 42) -> DataFrame:
    """Balance classes to the minority size without replacement: keep the rows
    whose seeded-hash rank inside their class is within the minority count."""
    k = df.groupBy(cls).count().select(F.min("count")).scalar()
    ranked = hash_rank_within(df, cls, key, seed)
    return ranked.filter(F.col("hash_rank") <= k).drop("hash_rank", "group_size")
