"""Relational building blocks shared by the plans.

Every helper is a composition of DataFrame operators; none collects rows.
Per-key reductions use aggregates (partial/map-side combine) rather than
windows, so one key holding a third of all rows is still reduced in many tasks
before its single final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``drop_duplicates(keep='last')`` made deterministic: the row with the
    greatest ``order`` tuple per key.  ``max_by`` over a struct is an aggregate,
    so a hot key is pre-reduced per task instead of being sorted in one window."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def latest_with_ties(df: DataFrame, key: str, date_col: str = "date") -> DataFrame:
    """Rows whose date equals their key's latest date (ties kept, like the
    ``JOIN (SELECT key, MAX(date) ...)`` form).  The max-date side is one row
    per key; AQE skew-join splits a hot key on the large side."""
    latest = df.groupBy(key).agg(F.max(date_col).alias("_latest"))
    return (df.join(latest, on=key, how="inner")
            .filter(F.col(date_col) == F.col("_latest")).drop("_latest"))


def frequent_values(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Values of ``col`` seen more than ``min_count`` times (one row per value)."""
    return df.groupBy(col).count().filter(F.col("count") > min_count).select(col)


def keep_frequent(df: DataFrame, cols: Sequence[str], min_count: int) -> DataFrame:
    """Sequential membership filter: for each column in turn keep the rows whose
    value is frequent among the rows that survived the previous column."""
    out = df
    for c in cols:
        out = out.join(frequent_values(out, c, min_count), on=c, how="left_semi")
    return out


def frequent_combinations(df: DataFrame, cols: Sequence[str], min_count: int) -> DataFrame:
    """Rows of ``keep_frequent`` per combination of ``cols`` (count ``n``), from one scan.

    Rows are counted per combination first; every filter then runs on the counts, so a
    window sees the combinations of one value, however many rows the value has."""
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    for c in cols:
        total = F.sum("n").over(Window.partitionBy(c))
        out = out.withColumn("_total", total).filter(F.col(c).isNotNull() & (F.col("_total") > min_count)).drop("_total")
    return out


def seeded_hash(*cols: str, seed: int) -> Column:
    """48 bits of a digest of the columns and a seed: a whole number that other engines can compute too."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def calendar_spine(df: DataFrame, keys: Sequence[str], date_col: str, step: str = "1 day",
                   global_range: bool = True) -> DataFrame:
    """(key, date) grid from the first to the last date.  With ``global_range``
    every key gets the overall min..max (the wide-matrix reindex); otherwise its
    own range.  Built with a per-key generator, not a cross join."""
    if global_range:
        lo = df.select(F.min(date_col)).scalar()
        hi = df.select(F.max(date_col)).scalar()
        base = df.select(*keys).distinct().withColumn("_lo", lo).withColumn("_hi", hi)
    else:
        base = df.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    seq = F.sequence(F.col("_lo"), F.col("_hi"), F.expr(f"INTERVAL {step}"))
    return base.select(*keys, F.explode(seq).alias(date_col))


def reconcile(df: DataFrame, keys: Sequence[str], date_col: str, values: Sequence[str],
              step: str = "1 day", fill: float | None = 0.0, global_range: bool = True) -> DataFrame:
    """Left-join the series onto its calendar spine; missing steps get ``fill``.

    The series (one row per key and step at most) is written once: its bounds, its keys and the join all read that,
    not the query that made it."""
    from mercato.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(*keys, date_col, *values).checkpoint()
    spine = calendar_spine(df, keys, date_col, step, global_range)
    out = spine.join(df.select(*keys, date_col, *values), on=[*keys, date_col], how="left")
    if fill is not None:
        out = out.select(*keys, date_col, *[F.coalesce(F.col(v), F.lit(fill)).alias(v) for v in values])
    return out


def rounded(c: Column | str, digits: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def money_avg(c: str) -> Column:
    """Mean of a 2-decimal money column as ``round(sum, 2) / count``: the rounded
    sum is exact whatever the summation order, so the quotient is reproducible
    across partitionings (a plain double ``avg`` differs in the last bits)."""
    return F.round(F.sum(c), 2) / F.count(c)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Make sure CPU-heavy per-row work (HTML parsing, Unicode folding) has at
    least ``min_partitions`` tasks (default: the cluster's parallelism).

    A large input already arrives in many file splits and is left untouched
    (no shuffle); only an input with too few splits (e.g. one big row group)
    is round-robin repartitioned."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
