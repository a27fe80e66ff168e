"""Best-fit packing of token sequences, certified and repacked.

Documents become pieces of at most ``capacity`` ids (only longer ones are cut; the first piece takes the
remainder).  Pieces are dealt at random into partitions of about ``group`` pieces, each packed by best-fit
decreasing.  Dual-feasible functions over the partition's lengths give a lower bound on its bins; bins
equal to the bound are certified optimal and stay.  The partitions with a gap exchange documents: the
pieces of their bins that are not full, and those of any partition's bins that are at most half full, are
pooled, dealt anew and packed again.  A round that saves no bin is dropped and ends the rounds.  A task
holds one partition's lengths, never texts or ids.

Defined cases: null or empty texts are one piece, the end id; repeated rows are packed separately; null ids are packed
like others and come back null; an empty table packs to nothing.  Only the named columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import saved
from mercato.llm.tokens import default_path, encoder

CAPACITY = 2048
END_ID = 0
GROUP = 40_000
ROUNDS = 4

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECES}, part bigint, sequence_id bigint, offset bigint, fill bigint, gap bigint"


def _cut(path: str, end: int, capacity: int):
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            keys, rows = b.column(0).to_pylist(), []
            for key, raw in zip(keys, enc.batch(x.as_py() for x in b.column(1))):
                ids = raw + tail
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                at, size, piece = 0, first, 0
                while at < n:
                    rows.append((key, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at, size, piece = at + size, capacity, piece + 1
            k, p, s, n, c = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(p, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(c, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_ID,
           tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(
        _cut(tokenizer or default_path(), end, capacity), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual-feasible functions, on the histogram.

    One drops lengths below a and rounds those above capacity - a up to capacity, for each a up to half;
    the other rounds to multiples of capacity / k."""
    if not len(lengths):
        return 0
    h = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    count, total = np.cumsum(h), np.cumsum(h * x)
    a = np.arange(0, capacity // 2 + 1)
    above = count[-1] - count[capacity - a]
    below = np.where(a > 0, total[np.maximum(a, 1) - 1], 0)
    best = int(np.max(-(-(above * capacity + total[capacity - a] - below) // capacity)))
    for k in range(1, 101):
        exact = (x * (k + 1)) % capacity == 0
        # values scaled by capacity * k: x * k, or floor((k + 1) x / capacity) * capacity
        value = np.where(exact, x * k, (x * (k + 1) // capacity) * capacity)
        best = max(best, int(-(-int((h * value).sum()) // (capacity * k))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin.  The open bins are kept by free space; a bit
    mask of the free spaces in use finds the tightest fit."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_free: dict[int, list[int]] = {}
    fills: list[int] = []
    mask = 0
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        room = mask >> n
        if room:
            free = n + (room & -room).bit_length() - 1
            held = by_free[free]
            b = held.pop()
            if not held:
                mask ^= 1 << free
        else:
            free, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        left = free - n
        if left:
            held = by_free.setdefault(left, [])
            if not held:
                mask |= 1 << left
            held.append(b)
    return bins, offsets, np.array(fills, dtype=np.int64)


def _pack(capacity: int, round_: int):
    def run(rows: pa.Table) -> pa.Table:
        order = ["length", "doc_id", "piece", "start", "ids_crc32"]
        rows = rows.sort_by([(c, "descending") for c in order])
        lengths = rows.column("length").to_numpy()
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        part = rows.column("part")[0].as_py()
        found = {"sequence_id": (round_ << 56) + (part << 24) + bins, "offset": offsets, "fill": fills[bins],
                 "gap": np.full(len(lengths), len(fills) - lower_bound(lengths, capacity))}
        for name, values in found.items():
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows

    return run


def _packed(rows: DataFrame, n: int, group: int, capacity: int, round_: int) -> DataFrame:
    """``rows`` (PIECES) dealt into partitions by a hash seeded with the round, and packed."""
    parts = max(1, -(-n // group))
    deal = F.pmod(F.xxhash64(F.lit(round_), "doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("long")
    dealt = rows.withColumn("part", deal).groupBy("part")
    return saved(dealt.applyInArrow(_pack(capacity, round_), PACKED), "packed")


def _bins(packed: DataFrame) -> int:
    return packed.filter("offset = 0").count()


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_ID,
         tokenizer: str | None = None, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``group`` bounds the pieces a task packs (at most 2**24 bins each); ``rounds`` the exchanges."""
    cut = saved(pieces(docs, key, text, capacity, end, tokenizer), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    current = _packed(cut, cut.count(), group, capacity, 0)
    done: list[DataFrame] = []
    for round_ in range(1, rounds + 1):
        loose = (F.col("fill") < capacity) & ((F.col("gap") > 0) | (2 * F.col("fill") <= capacity))
        pool = current.filter(loose)
        n, before = pool.count(), _bins(pool)
        if n == 0 or before < 2:
            break
        again = _packed(pool.select(*[c.split()[0] for c in PIECES.split(", ")]), n, group, capacity, round_)
        if _bins(again) >= before:
            break
        done.append(current.filter(~loose))
        current = again
    for part in done:
        current = current.unionByName(part)
    return current.select(*names)
