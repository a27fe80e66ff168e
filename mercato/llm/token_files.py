"""Token-id files: ORC with integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt into ranges of ascending id and sorted, each range is encoded in one task as it is
written, and becomes one ORC file.  ORC stores the ids in stripes, run-length encoded to the bits they
need; the row index and the Bloom filter on the id let a reader skip stripes and row groups.  A reader
takes stripes in parallel: the place of a document in the whole id sequence follows from the sums of the
files before it (one row per file) and the rows before it in its file.

Defined cases: a null or empty text is the end id alone; null ids come first; rows with equal ids follow
each other by text; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import shuffle_partitions
from mercato.llm.tokens import default_path, encoder

END_ID = 2
SCHEMA = "doc_id bigint, place bigint, n_tokens bigint, ids array<int>"
#: Ids in one Arrow batch on its way to the writer.
BATCH_IDS = 1 << 20

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(64 << 20),
    "compression": "zstd",
}


def _encode(path: str, end: int):
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        enc, place = encoder(path), 0
        for b in batches:
            keys, parts, held, first = b.column(0), [], 0, 0
            for i, raw in enumerate(enc.batch(x.as_py() for x in b.column(1))):
                parts.append(raw + tail)
                held += len(raw) // 4
                if held >= BATCH_IDS:
                    yield _batch(keys.slice(first, len(parts)), place, parts)
                    place, first, parts, held = place + len(parts), i + 1, [], 0
            if parts:
                yield _batch(keys.slice(first, len(parts)), place, parts)
                place += len(parts)

    return run


def _batch(keys: pa.Array, place: int, parts: list[bytes]) -> pa.RecordBatch:
    sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    ids = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
    return pa.RecordBatch.from_arrays(
        [keys.cast(pa.int64()), pa.array(np.arange(place, place + len(parts))), pa.array(sizes),
         pa.ListArray.from_arrays(pa.array(ends), ids)], names=["doc_id", "place", "n_tokens", "ids"])


def write_ids(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", end: int = END_ID,
              tokenizer: str | None = None, files: int | None = None) -> None:
    """Encode whole texts and write them to ``folder``, one file per range of ids, in ascending order."""
    files = files or shuffle_partitions(docs.sparkSession)
    ranged = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
              .repartitionByRange(files, F.col("doc_id").asc_nulls_first())
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    ranged.mapInArrow(_encode(tokenizer or default_path(), end), SCHEMA).write.options(**ORC_OPTIONS).orc(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the files: doc_id, place in its file, n_tokens, ids, file."""
    return spark.read.schema(SCHEMA).orc(folder).withColumn("file", F.col("_metadata.file_name"))


def _checksum(batches):
    for b in batches:
        ids = b.column("ids")
        values = np.asarray(ids.values, dtype="<i4") if len(ids) else np.empty(0, "<i4")
        offsets = np.asarray(ids.offsets) if len(ids) else [0]
        crc = [zlib.crc32(values[offsets[i] : offsets[i + 1]]) for i in range(len(ids))]
        n = [int(offsets[i + 1] - offsets[i]) for i in range(len(ids))]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("place"), b.column("file"), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "place", "file", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """What the files hold per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Only numbers are shuffled; a file's rows meet in one task, as they did when it was written."""
    rows = read_ids(spark, folder).select("doc_id", "place", "file", "ids").mapInArrow(
        _checksum, "doc_id bigint, place bigint, file string, n_tokens bigint, ids_crc32 bigint")
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    sums = spark.read.schema(SCHEMA).orc(folder).select("n_tokens", F.col("_metadata.file_name").alias("file"))
    sums = sums.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # one row per file; Spark numbers the files in the order of their ranges
    order = Window.orderBy(F.regexp_extract("file", r"part-(\d+)", 1).cast("long")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("files_before"))
    return rows.join(sums, "file").select("doc_id", (F.col("files_before") + F.col("before")).alias("start"), "n_tokens",
                                          "ids_crc32")
