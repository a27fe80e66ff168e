"""Sinks: table replacement, partitioned parquet, idempotent upserts, star
schema normalisation and per-run data-quality rows.

Writes go to the shared storage named by the caller (on a cluster, never a
machine-local folder).  Re-running a write of the same input yields the same
table: overwrites are whole-table or dynamic per-partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.relational import latest_per_key, seeded_hash


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """``DROP IF EXISTS`` + ``CREATE TABLE AS``: a whole-table overwrite."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], salts: int = 8) -> None:
    """Partitioned parquet; rows are clustered by the partition columns and one of ``salts`` random
    numbers first, so a day or brand with most rows is written by several tasks and each task
    still writes few files."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    (df.repartition(*partition_cols, salt).write.mode("overwrite")
     .partitionBy(*partition_cols).parquet(path))


def merge_latest(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Upsert image: union both sides and keep the latest row per key."""
    return latest_per_key(existing.unionByName(incoming, allowMissingColumns=True), keys, order)


def _exists(spark, path: str) -> bool:
    """Whether ``path`` holds anything, asked of the file system Spark itself would read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target) and len(fs.listStatus(target)) > 0


def upsert_partitions(incoming: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                      partition_col: str) -> None:
    """Idempotent upsert by key into a partitioned parquet table.

    Rewritten are the partitions that ``incoming`` touches and those that hold an older row of one of
    its keys, so a key that changes partition stays once.  A partition whose last row moved away is
    rewritten too: its remaining rows, if any, are part of the image.  Only a missing table counts as the
    first run; every other failure is raised and leaves the table as it was.  An existing
    column whose type differs from the incoming one is an error."""
    from mercato.session import ensure_checkpoint_dir
    spark = incoming.sparkSession
    ensure_checkpoint_dir(spark)
    if not _exists(spark, path):
        latest_per_key(incoming, keys, order).write.partitionBy(partition_col).parquet(path)
        return
    kinds = dict(incoming.dtypes)
    # Partition values are read as the incoming type, not guessed from the folder names ("007" is no number).
    found = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, incoming.schema[f.name].dataType if f.name == partition_col else f.dataType)
                           for f in found])
    existing = spark.read.schema(schema).parquet(path)
    clash = sorted(c for c, t in existing.dtypes if c in kinds and kinds[c] != t)
    if clash:
        raise ValueError(f"columns change their type: {', '.join(clash)}")
    if kinds[partition_col] == "string":  # an empty folder value is null
        incoming = incoming.withColumn(partition_col, F.when(F.col(partition_col) != "", F.col(partition_col)))
    moved = _semi(existing, incoming.select(*keys).distinct(), keys, "left_semi").select(partition_col)
    touched = incoming.select(partition_col).union(moved).distinct().checkpoint()
    held = _semi(existing, touched, [partition_col], "left_semi")
    # Materialise before overwriting the folder we are reading from.
    merged = merge_latest(held, incoming, keys, order).checkpoint()
    left = _semi(touched, merged.select(partition_col).distinct(), [partition_col], "left_anti")
    emptied = [r[0] for r in left.select(F.col(partition_col).cast("string")).collect()]
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    # Partitions that lost all their rows (bounded by the touched ones) get no new files: remove the old.
    # Folder names are Spark's own, with its escapes and its name for null.
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in emptied:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        target = spark._jvm.org.apache.hadoop.fs.Path(root, names.getPartitionPathString(partition_col, value))
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _semi(df: DataFrame, other: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which null keys are equal."""
    named = other.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(on)])
    cond = F.col(on[0]).eqNullSafe(F.col("_o0"))
    for i, c in enumerate(on[1:], 1):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    return df.join(named, cond, how)


def sample_export(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """Deterministic sample: rows whose seeded key hash falls in the first
    ``fraction`` of the hash space (same rows on every run and partitioning)."""
    bucket = seeded_hash(key, seed=seed) % 1_000_000
    return df.filter(bucket < int(fraction * 1_000_000))


def date_dimension(dates: DataFrame, col: str = "date") -> DataFrame:
    """Every calendar day between the first and last date, with its parts."""
    b = dates.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    d = b.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return d.select(F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_id"), "full_date",
                    F.weekday("full_date").alias("day_of_week"), F.dayofmonth("full_date").alias("day_of_month"),
                    F.month("full_date").alias("month"), F.year("full_date").alias("year"))


def quality_report(df: DataFrame, keys: Sequence[str], not_null: Sequence[str], positive: Sequence[str]) -> DataFrame:
    """One row per run: rows, distinct keys, duplicate keys, nulls, rule violations."""
    key = F.struct(*keys)
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys")]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    rules = [F.count_if(F.col(c) <= 0).alias(f"nonpositive_{c}") for c in positive]
    r = df.agg(*counts, *nulls, *rules)
    return r.withColumn("duplicate_keys", F.col("n_rows") - F.col("n_keys"))


def write_grouped_json(df: DataFrame, path: str, group_col: str, id_col: str, item_cols) -> None:
    """One JSON folder per group value: each line is an id with its sorted
    array of items (``{district}/...`` files of ids -> items).  A group is written by as many tasks as shuffles have
    partitions, at most, so a group with most ids does not wait for a few of them."""
    items = F.sort_array(F.collect_list(F.struct(*item_cols))).alias("items")
    grouped = df.groupBy(group_col, id_col).agg(items)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (grouped.repartition(tasks, group_col, F.pmod(F.xxhash64(id_col), F.lit(tasks)))
     .write.mode("overwrite").partitionBy(group_col).json(path))
