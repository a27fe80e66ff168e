"""Exact global ranks without a single-task window.

Rows are first reduced to one row per distinct value (an aggregate).  The distinct values are dealt into
ranges by Spark's range partitioning, the cumulative count runs per range in parallel, and a
per-range offset table is added back (see ``ranges``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ranges import group_of, in_ranges, offsets


def rank_table(df: DataFrame, col: str, extra_counts: Sequence[tuple[str, object]] = (),
               buckets: int | None = None, weight: str | None = None) -> DataFrame:
    """One row per distinct ``col`` value with its count ``c``, the number of
    rows strictly below it (``below``) and its tie-averaged rank ``avg_rank``.
    ``extra_counts`` adds conditional counts, e.g. ``("pos", F.col("y") == 1)``;
    ``weight`` names a column of pre-aggregated row counts; ``buckets`` is the
    session's number of shuffle partitions unless given."""
    if weight:
        aggs = [F.sum(weight).alias("c")] + [F.sum(F.when(cond, F.col(weight)).otherwise(0)).alias(name)
                                             for name, cond in extra_counts]
    else:
        aggs = [F.count(F.lit(1)).alias("c")] + [F.count_if(cond).alias(name) for name, cond in extra_counts]
    counts = df.groupBy(col).agg(*aggs)
    names = ["c", *[e[0] for e in extra_counts]]
    ranged = in_ranges(counts, [col], buckets)
    off = offsets(ranged.withColumn("_g", group_of(())), names).select("_r", *[f"{n}_off" for n in names])
    before = Window.partitionBy("_r").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    x = ranged.join(F.broadcast(off), "_r")  # one row per range: bounded by the number of partitions
    out = x.select(col, *names, *[(F.col(f"{n}_off") + F.coalesce(F.sum(n).over(before), F.lit(0))).alias(f"below_{n}")
                                  for n in names])
    return out.withColumnRenamed("below_c", "below").withColumn(
        "avg_rank", F.col("below") + (F.col("c") + 1) / 2.0)
