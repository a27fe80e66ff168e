"""Small helpers shared by the operators: tables, saved intermediates, ranges of an ordered key."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir, ship_package

#: A word of the contracts: code points other than space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/mercato/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and a
    lost executor costs a reread rather than a recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable is bound, not copied)."""
    return F.transform(F.array(value), body)[0]


def settled(df: DataFrame, mark: str) -> DataFrame:
    """``df`` with a column ``mark`` that Spark cannot compute ahead, for filters on columns that are dear to
    compute: a filter that names it stays above them.  Else Spark would move the filter below and put the
    columns' whole expressions, also inside the functions applied to every array element, in its place."""
    return df.withColumn(mark, F.spark_partition_id())


def cuts(df: DataFrame, key: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending cut points that deal the non-null ``key`` (a whole number) into
    ranges of about equal rows.  The quantile sketch reads every row of that one column."""
    if ranges < 2:
        return []
    got = df.filter(F.col(key).isNotNull()).approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    return sorted({int(x) for x in got})


def range_of(key: Column, points: list[int]) -> Column:
    """0-based number of the range that holds ``key``: how many cut points lie below it.  Two levels of
    about sqrt(n) comparisons.  Null keys fall in range 0."""
    if not points:
        return F.lit(0)
    step = max(1, int(len(points) ** 0.5))
    blocks = [points[i : i + step] for i in range(0, len(points), step)]
    heads = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    rows = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])

    def below(a: Column) -> Column:
        return F.size(F.filter(a, lambda x: x < key))

    block = below(heads)
    inner = F.when(block > 0, below(F.get(rows, block - 1))).otherwise(0)
    return F.when(key.isNull(), 0).otherwise(F.greatest(block - 1, F.lit(0)) * step + inner)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def has_rows(df: DataFrame) -> bool:
    return len(df.take(1)) > 0
