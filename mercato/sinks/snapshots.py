"""Tables whose every write is a new snapshot, on plain parquet folders.

Data files are staged in a folder of their own; the write becomes visible when the list of folders that make up the
table (its manifest, one line per partition) is renamed into place.  A run that ends in between leaves the
table as it was, and a rerun starts anew; readers keep the snapshot they opened.  A partition's folder is named
by a digest of its value, so null, empty and odd values need no escaping, and the column itself stays in the files.
Rows are written and read by Spark alone; the driver holds the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.ranges import in_ranges
from mercato.operators.relational import latest_per_key
from mercato.session import ensure_checkpoint_dir

PART = "snap_part"


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` whose rows move with their order columns once, not twice; of rows equal in these, the largest."""
    first = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not first + rest or any("map<" in t for _, t in df.dtypes):  # maps have no order
        return latest_per_key(df, keys, order)
    return df.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


class SnapshotTable:
    """A parquet table at ``path`` (shared storage), partitioned by one column or not at all."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str | None = None, salts: int = 8):
        self.spark, self.path, self.partition_col, self.salts = spark, path.rstrip("/"), partition_col, salts

    # -- manifest

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p, fs = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(f"{self.path}/manifest") if n.startswith("v") and n.endswith(".json"))

    def _manifest(self, version: int | None = None) -> dict:
        found = self.versions()
        if not found:
            return {"schema": None, "parts": []}
        p, fs = self._fs(f"{self.path}/manifest/v{version or found[-1]}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, schema: T.StructType, parts: list) -> None:
        """Name the table's folders; another writer's commit of the same version is an error."""
        version = (self.versions() or [0])[-1] + 1
        staged, fs = self._fs(f"{self.path}/staged/{uuid.uuid4().hex}.json")
        out = fs.create(staged, False)
        out.write(bytearray(json.dumps({"schema": schema.json(), "parts": parts}).encode()))
        out.close()
        final, _ = self._fs(f"{self.path}/manifest/v{version}.json")
        fs.mkdirs(final.getParent())
        if fs.exists(final) or not fs.rename(staged, final):
            raise RuntimeError(f"another writer has made version {version} of {self.path}")

    # -- data

    def _digest(self, col: str | None = None) -> Column:
        value = F.col(col or self.partition_col).cast("string") if self.partition_col else F.lit(None)
        return F.coalesce(F.md5(value), F.lit("null"))

    def _stage(self, df: DataFrame) -> list:
        """Write ``df`` in a new folder; a partition with most rows is written by several tasks."""
        name = f"data/{uuid.uuid4().hex}"
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(self.salts))
        df.withColumn(PART, self._digest()).repartition(F.col(PART), salt).write.partitionBy(PART).parquet(f"{self.path}/{name}")
        return [[n.split("=", 1)[1], f"{name}/{n}"] for n in self._names(f"{self.path}/{name}") if n.startswith(PART)]

    def _rows(self, manifest: dict, only: set[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        folders = [f"{self.path}/{f}" for part, f in manifest["parts"] if only is None or part in only]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (the latest by default)."""
        manifest = self._manifest(version)
        if manifest["schema"] is None:
            raise ValueError(f"no table at {self.path}")
        return self._rows(manifest)

    def replace(self, df: DataFrame) -> None:
        self._commit(df.schema, self._stage(df))

    def append(self, df: DataFrame) -> None:
        old = self._manifest()
        self._commit(df.schema, old["parts"] + self._stage(df))

    def upsert(self, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> None:
        """The latest row per key by ``order``, of the table and ``incoming``; nulls are values of a key like others.

        Only rows that are newer than the table's count, and only partitions that these touch or that hold one of their keys
        are rewritten; a replay moves nothing but keys.  Both are found by a read of the keys, the order and a digest."""
        old = self._manifest()
        if old["schema"] is None:
            self.replace(newest(incoming, keys, order))
            return
        before = self._rows(old)
        kinds = dict(before.dtypes)
        clash = sorted(c for c, t in incoming.dtypes if kinds.get(c, t) != t)
        if clash:
            raise ValueError(f"columns change their type: {', '.join(clash)}")
        ensure_checkpoint_dir(self.spark)
        columns = incoming.columns
        ordered = set(order) <= set(columns) & set(before.columns)  # else rows cannot be compared, and all count as new
        whole = F.lit(None).cast("bigint")
        if set(columns) == set(before.columns) and not any("map<" in t for t in kinds.values()):
            whole = F.xxhash64(*before.columns, F.array(*[F.col(c).isNull() for c in before.columns]))
        # rows of the load are reduced, and written, once
        incoming = newest(incoming, keys, order).checkpoint()
        known = before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(True).alias("_known"), whole.alias("_whole"),
                              *([F.col(self.partition_col).alias("_part")] if self.partition_col else []),
                              *([F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] if ordered else []))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        # what the table has already, or has newer, changes nothing
        stale = F.lit(False)
        if ordered:
            mine, other = F.struct(*order), F.struct(*[F.col(f"_o{i}").alias(c) for i, c in enumerate(order)])
            stale = F.coalesce(F.col("_known") & ((mine < other) | ((mine == other) & (whole == F.col("_whole")))), F.lit(False))
        new = incoming.join(known, same, "left").filter(~stale).withColumn(PART, self._digest()).withColumn(
            "_part", F.when(F.col("_known"), self._digest("_part"))).select(*columns, PART, "_part").checkpoint()
        touched = {r[0] for r in new.select(PART).union(new.filter("_part is not null").select("_part")).distinct().collect()}
        incoming = new.select(*columns)
        if not touched:
            self._commit(before.schema, old["parts"])
            return
        merged = newest(self._rows(old, touched).unionByName(incoming, allowMissingColumns=True), keys, order)
        merged = merged.select(*before.columns, *[c for c in incoming.columns if c not in before.columns])
        parts = [p for p in old["parts"] if p[0] not in touched]
        self._commit(merged.schema, parts + self._stage(merged))

    def expire(self, keep: int = 2) -> None:
        """Delete the manifests before the last ``keep`` and the folders that no kept manifest names."""
        found = self.versions()
        kept = found[-keep:]
        named = {f for v in kept for _, f in self._manifest(v)["parts"]}
        for v in found[:-keep]:
            for _, folder in self._manifest(v)["parts"]:
                if folder not in named:
                    p, fs = self._fs(f"{self.path}/{folder}")
                    fs.delete(p, True)
            p, fs = self._fs(f"{self.path}/manifest/v{v}.json")
            fs.delete(p, False)


def surrogate_keys(values: DataFrame, col: str, path: str) -> DataFrame:
    """Dense whole-number keys of the distinct non-null values of ``col``: (``col``, ``<col>_key``).

    The registry at ``path`` only grows: known values keep their keys, new ones go on after the largest in the order of
    the values.  They are numbered by ranges (a running number in each, and one row per range for what comes before), so
    no task sees all of them.  A rerun, or a crash before the commit, assigns the same keys."""
    spark = values.sparkSession
    registry, key = SnapshotTable(spark, path), f"{col}_key"
    new = values.select(col).filter(F.col(col).isNotNull()).distinct()
    last = 0
    if registry.exists():
        known = registry.read()
        last = known.agg(F.max(key)).first()[0] or 0
        new = new.join(known.select(col), col, "left_anti")
    ranged = in_ranges(new, [col])
    if ranged.take(1) or not registry.exists():
        before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
        off = ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("_m")).select(
            "_r", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_off"))
        place = F.row_number().over(Window.partitionBy("_r").orderBy(col))
        registry.append(ranged.join(F.broadcast(off), "_r").select(col, (F.lit(last) + F.col("_off") + place).cast("bigint").alias(key)))
    return registry.read()
