"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets by a seeded hash of their id (of their text where the
id is null); there are as many buckets as keep each at about ``bucket_bytes``.  Pass two loads a bucket,
puts its rows into a defined order, shuffles them by Fisher-Yates with a generator seeded by bucket, and
writes them.  A record's place in the whole permutation is its place in its bucket plus the rows of the
buckets before; equal cuts of that sequence are the shards, whose counts are at most one apart (law
``rows``).  Cutting contiguously lets a bucket touch at most a few shards, so files stay large.

The same rows, seed and bucket count give the same shards, whichever executor runs what.  Defined cases:
null texts count 1 byte and stay null; repeated rows are interchangeable; more shards than rows leave the last
ones empty; an empty table writes no rows.  Rows that repeat one id meet in one bucket: with ids that are
unique, as in a table of documents, buckets are even whatever the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import saved, shuffle_partitions

LAW = "rows"
SEED = 17
BUCKET_BYTES = 64 << 20


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def bucket_of(key: Column, text: Column, seed: int, buckets: int) -> Column:
    who = F.coalesce(F.xxhash64(F.lit(seed), key), F.lit(0))
    return F.pmod(F.when(key.isNull(), F.xxhash64(F.lit(seed), text)).otherwise(who), F.lit(buckets)).cast("int")


def _shuffled(seed: int):
    def run(table: pa.Table) -> pa.Table:
        n = table.num_rows
        bucket = table.column("_s_bucket")[0].as_py()
        table = table.take(pyarrow.compute.sort_indices(table, sort_keys=[("_s_key", "ascending"), ("_s_tie", "ascending")]))
        swaps = np.random.default_rng([seed, bucket])
        order = np.arange(n)
        swaps.shuffle(order)  # Fisher-Yates, in place
        return table.take(pa.array(order)).append_column("_s_place", pa.array(np.arange(n, dtype=np.int64)))

    return run


def shuffled(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``_s_position`` (0-based place in the permutation) and ``_s_total`` (rows in all)."""
    names = docs.columns
    total = docs.agg(F.sum(size_of(F.col(text)))).first()[0] or 0
    buckets = max(shuffle_partitions(docs.sparkSession), -(-total // bucket_bytes))
    b = docs.select(*[F.col(c) for c in names], F.col(key).alias("_s_key"), F.xxhash64(text).alias("_s_tie"),
                    bucket_of(F.col(key), F.col(text), seed, buckets).alias("_s_bucket"))
    # one row per bucket; a running sum over buckets, not over records
    counts = saved(b.groupBy("_s_bucket").agg(F.count(F.lit(1)).alias("_s_n")), "shard-buckets")
    before = Window.orderBy("_s_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_s_before", F.coalesce(F.sum("_s_n").over(before), F.lit(0))).drop("_s_n")
    n = counts.agg(F.sum("_s_n")).first()[0] or 0
    out = T.StructType([*b.schema.fields, T.StructField("_s_place", T.LongType())])
    placed = b.groupBy("_s_bucket").applyInArrow(_shuffled(seed), out)
    return placed.join(offsets, "_s_bucket").withColumn("_s_position", F.col("_s_before") + F.col("_s_place")).withColumn(
        "_s_total", F.lit(n)).select(*names, "_s_position", "_s_total")


def write_shards(docs: DataFrame, folder: str, shards: int = 8, key: str = "doc_id", text: str = "text",
                 seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``docs`` as Parquet below ``folder``, one sub-folder ``shard=i`` per shard, with the column ``slot``
    (place in the shard, from 0)."""
    s = shuffled(docs, key, text, seed, bucket_bytes)
    # in whole numbers: shard i holds the positions p with p * shards div total = i, the first of them
    # being the least p with p * shards >= i * total
    s = s.withColumn("shard", F.expr(f"cast((_s_position * {shards}) div _s_total as int)"))
    s = s.withColumn("slot", F.expr(f"_s_position - (shard * _s_total + {shards} - 1) div {shards}"))
    s.drop("_s_position", "_s_total").write.partitionBy("shard").parquet(folder)


def digests(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per record of the written shards: id, size, text_crc32, law, shard, slot, grown_shard."""
    kinds = dict(docs.dtypes)
    schema = f"`{key}` {kinds[key]}, `{text}` {kinds[text]}, slot bigint, shard int"
    got = docs.sparkSession.read.schema(schema).parquet(folder)
    return got.select(F.col(key), size_of(F.col(text)).alias("size"),
                      F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
