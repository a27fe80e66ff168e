"""Gradient boosted regression trees over category numbers and numeric columns.

The algorithm is that of ``pyspark.ml``'s ``GBTRegressor`` (squared error, variance gain, all features at each node) on the
one-hot features of ``operators.ml.onehot_pipeline``, and so are its trees: the same thresholds, splits, subsamples
and predictions, up to the rounding of sums.  What differs is the work.  A one-hot column is not held, nor is its histogram
filled row by row: the sums of "brand = x" are one entry of the sums by brand, those of "brand <> x" the node's total without
it.  A row is its codes, one small number a column, and its error; a pass over the rows adds each to one entry a column.

Rows are packed into blocks once (``Binned``), and these held by Spark, in memory as far as it goes.  Each level of a tree is one
pass that returns one array of sums a task; the errors are written anew once a tree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import ship_package

#: Rows of a block, and blocks that one task of a pass reads at most (about).
BLOCK_ROWS, TASK_BLOCKS = 100_000, 16
#: Gains within this share of the largest are equal, and so is 0 to this share of a node's squares: sums are rounded.
EQUAL = 1e-11

_BLOCK = "part int, at long, rows int, codes binary, error binary"
_M64 = (1 << 64) - 1


# ----------------------------------------------------------------------------------------------
# Spark's draws

def _murmur(data: bytes, seed: int) -> int:
    """Scala's MurmurHash3 of whole 4-byte words."""
    h = seed & 0xFFFFFFFF
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def xorshift_seed(seed: int) -> int:
    """The state that Spark's generator takes from ``seed``."""
    data = (seed & _M64).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(s):
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


def _images(bits: np.ndarray):
    """The map of states that takes the single bits to ``bits``, as tables by byte."""
    tables = np.zeros((8, 256), np.uint64)
    for b in range(64):
        tables[b // 8] ^= np.where(np.arange(256) >> (b % 8) & 1, bits[b], np.uint64(0))

    def far(s):
        out = tables[0][s & np.uint64(255)]
        for j in range(1, 8):
            out ^= tables[j][s >> np.uint64(8 * j) & np.uint64(255)]
        return out

    return far


def xorshift_doubles(seed: int, n: int, skip: int = 0) -> np.ndarray:
    """``n`` doubles of Spark's generator, after ``skip`` others.  Its step is linear over bits, so that a known run of states
    gives the next run of the same length by one map, and a power of the step jumps ahead."""
    states = np.empty(max(1, 2 * n), np.uint64)
    states[0] = _step(np.array([xorshift_seed(seed)], np.uint64))[0]
    one = _step(np.uint64(1) << np.arange(64, dtype=np.uint64))  # images of the bits under one step
    bits, far = one, 2 * skip
    while far:
        power = _images(bits)
        if far & 1:
            states[:1] = power(states[:1])
        bits, far = power(bits), far >> 1
    bits, known = one, 1
    while known < len(states):
        power = _images(bits)
        more = min(known, len(states) - known)
        states[known : known + more] = power(states[:more])
        bits, known = power(bits), known + more
    high, low = states[0 : 2 * n : 2] & np.uint64((1 << 26) - 1), states[1 : 2 * n : 2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(np.float64) * 2.0 ** -53


def _sampled(frame: DataFrame, cols: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """The rows that Spark's trees look at for thresholds."""
    spark = frame.sparkSession
    frame = frame.select(*cols)
    if fraction >= 1:
        return frame
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    rows = frame._jdf.javaRDD().sample(False, float(fraction), draw)
    return DataFrame(spark._jsparkSession.createDataFrame(rows, frame._jdf.schema()), spark)


def thresholds(values: np.ndarray, counts: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """At most ``splits`` cut points between the distinct ``values`` of a sample: all midpoints if they are few, else those next to
    equal shares.  Rows of the ``expected`` number that have none of the values count as zeros."""
    seen = values != 0
    values, counts = values[seen], counts[seen].astype(float)
    if not len(values):
        return np.empty(0)
    if expected - counts.sum() > np.finfo(float).eps * counts.sum() * 100:
        values, counts = np.append(values, 0.0), np.append(counts, expected - counts.sum())
    order = np.argsort(values)  # nan last
    values, counts = values[order], counts[order]
    mid = (values[:-1] + values[1:]) / 2
    if len(mid) > splits:
        stride, found, now = expected / (splits + 1), [], counts[0]
        target = stride
        for i in range(1, len(values)):
            before, now = now, now + counts[i]
            if abs(before - target) < abs(now - target):
                found.append(mid[i - 1])
                target += stride
        mid = np.array(found)
    return mid[~np.isnan(mid)]  # nothing lies right of nan


# ----------------------------------------------------------------------------------------------
# Rows as codes

@dataclass(frozen=True)
class Layout:
    """Columns of category numbers with the size of each one's one-hot vector, then numeric columns with their cut points."""

    cats: tuple[str, ...]
    sizes: tuple[int, ...]
    nums: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]

    @property
    def bins(self) -> list[int]:
        return [*self.sizes, *(len(c) + 1 for c in self.cuts)]

    @property
    def starts(self) -> list[int]:
        return [0, *np.cumsum(self.bins).tolist()]

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """One row of codes a column."""
        kind = np.uint8 if max(self.bins) <= 256 else np.uint16 if max(self.bins) <= 65536 else np.uint32
        k = len(self.cats)
        out = [np.asarray(c, np.float64).astype(kind) for c in columns[:k]]
        out += [np.searchsorted(cut, c, side="left").astype(kind) for cut, c in zip(self.cuts, columns[k:])]
        return np.stack(out) if len(columns[0]) else np.empty((len(columns), 0), kind)

    def unpacked(self, data: bytes, rows: int) -> np.ndarray:
        return np.frombuffer(data, self.codes([np.empty(0)] * len(self.bins)).dtype).reshape(len(self.bins), rows)


def _plain(column) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _pack(layout: Layout):
    def run(batches):
        from pyspark import TaskContext
        part, at, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def block():
            t = pa.Table.from_batches(held)
            columns = [_plain(t.column(i).combine_chunks()) for i in range(t.num_columns)]
            if np.isnan(columns[-1]).any():
                raise ValueError("Labels MUST NOT be Null or NaN")
            if not all(np.isfinite(c).all() for c in columns[:-1]):
                raise ValueError("Vector values MUST NOT be NaN or Infinity")
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([t.num_rows], pa.int32()),
                pa.array([layout.codes(columns[:-1]).tobytes()], pa.binary()), pa.array([columns[-1].tobytes()], pa.binary())], names=[c.split()[0] for c in _BLOCK.split(", ")])

        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= BLOCK_ROWS:
                yield block()
                at, held, rows = at + rows, [], 0
        if rows:
            yield block()

    return run


class Binned:
    """The rows of a training frame as blocks of codes and labels.  ``sizes`` are the lengths of the columns' one-hot vectors;
    ``release`` gives the blocks up."""

    def __init__(self, frame: DataFrame, cats: Sequence[str], sizes: Sequence[int], nums: Sequence[str], label: str = "label", bins: int = 32, seed: int = 42):
        spark = frame.sparkSession
        ship_package(spark)
        self.rows = frame.count()
        if not self.rows:
            raise ValueError("trees need rows")
        most = min(bins, self.rows)
        share = min(1.0, max(bins * bins, 10_000) / self.rows)
        found = _sampled(frame, nums, share, seed).toPandas()
        cuts = []
        for c in nums:
            v = found[c].to_numpy(np.float64, na_value=np.nan)
            values, counts = np.unique(v, return_counts=True)
            cuts.append(thresholds(values, counts, share * self.rows, most - 1))
        self.layout, self.label = Layout(tuple(cats), tuple(sizes), tuple(nums), tuple(cuts)), label
        packed = frame.select(*[F.col(c).cast("double") for c in (*cats, *nums, label)])
        self.blocks = packed.mapInArrow(_pack(self.layout), _BLOCK).persist()
        n = self.blocks.count()
        self.tasks = max(spark.sparkContext.defaultParallelism, -(-n // TASK_BLOCKS))

    def release(self) -> None:
        self.blocks.unpersist()


# ----------------------------------------------------------------------------------------------
# Trees

@dataclass
class Tree:
    """Nodes by heap number (1 is the root, 2i and 2i + 1 its children), grown to ``depth`` levels; a row at a leaf goes left.
    ``column`` is a split's column, ``right`` says which codes go right, ``value`` is the prediction."""

    depth: int
    column: np.ndarray
    right: np.ndarray
    value: np.ndarray
    #: (heap number, feature of the one-hot vector, gain times rows) of every split
    splits: list[tuple[int, int, float]] = field(default_factory=list)

    def nodes(self, codes: np.ndarray, depth: int | None = None) -> np.ndarray:
        n = codes.shape[1]
        node, every, flat = np.ones(n, np.int64), np.arange(n), codes.reshape(-1)
        width, start, right = self.right.shape[1], self.column * n, self.right.reshape(-1)
        for _ in range(self.depth if depth is None else depth):
            code = flat[start[node] + every]
            node = 2 * node + right[node * width + code]
        return node


def _empty_tree(depth: int, width: int) -> Tree:
    n = 2 ** (depth + 1)
    return Tree(depth, np.zeros(n, np.int64), np.zeros((n, width), bool), np.zeros(n))


def _subsample(layout: Layout, share: float, seed: int):
    """Blocks of the rows that a tree is grown on."""
    def run(batches):
        for b in batches:
            for part, at, rows, data, error in _blocks(b):
                kept = xorshift_doubles(seed + part + 1, rows, at) < share
                codes = layout.unpacked(data.as_buffer(), rows)[:, kept]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([int(kept.sum())], pa.int32()), pa.array([codes.tobytes()], pa.binary()),
                    pa.array([np.frombuffer(error.as_buffer(), np.float64)[kept].tobytes()], pa.binary())], names=b.schema.names)

    return run


def _blocks(batch):
    return zip(*(c.to_pylist() if i < 3 else c for i, c in enumerate(batch.columns)))


def _level(layout: Layout, tree: Tree, level: int, slots: np.ndarray, factor: float):
    """Sums of a level: rows and errors by (open node, bin), and rows, errors and squares by open node."""
    starts, bins = layout.starts, layout.bins
    n_open, width = int(slots.max()) + 1, starts[-1]

    def run(batches):
        n, s, total, first = np.zeros((n_open, width), np.int64), np.zeros((n_open, width)), np.zeros((n_open, 3)), None
        for b in batches:
            for part, at, rows, data, error in _blocks(b):
                first = (part, at) if first is None else min(first, (part, at))
                codes, e = layout.unpacked(data.as_buffer(), rows), np.frombuffer(error.as_buffer(), np.float64)
                slot = slots[tree.nodes(codes, level)]
                if (slot < 0).any():
                    kept = slot >= 0
                    codes, e, slot = codes[:, kept], e[kept], slot[kept]
                e = factor * e
                total += np.stack([np.bincount(slot, w, n_open) for w in (None, e, e * e)], axis=1)
                for f, size in enumerate(bins):
                    cell = slot * size + codes[f]
                    n[:, starts[f] : starts[f + 1]] += np.bincount(cell, minlength=n_open * size).reshape(n_open, size)
                    s[:, starts[f] : starts[f + 1]] += np.bincount(cell, e, n_open * size).reshape(n_open, size)
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first[0]], pa.int32()), pa.array([first[1]], pa.int64()), *(
                pa.array([x.tobytes()], pa.binary()) for x in (n, s, total))], names=["part", "at", "n", "s", "total"])

    return run


def _advance(layout: Layout, tree: Tree, rate: float):
    """Blocks whose errors are those after ``tree``."""
    def run(batches):
        for b in batches:
            rows, errors = b.column(2).to_pylist(), []
            for data, error, n in zip(b.column(3), b.column(4), rows):
                now = np.frombuffer(error.as_buffer(), np.float64) - rate * tree.value[tree.nodes(layout.unpacked(data.as_buffer(), n))]
                errors.append(now.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(errors, pa.binary())], names=b.schema.names)

    return run


def _candidates(layout: Layout, n: np.ndarray, s: np.ndarray, total: tuple[int, float]):
    """Of one node: rows and sum of the left side, feature, column and code (of a cut, the last that goes left) of every split,
    in the order of the one-hot vector.  A category is left if its mean is below that of the others."""
    rows, errors = total
    out = []
    for f, size in enumerate(layout.bins):
        here = slice(layout.starts[f], layout.starts[f + 1])
        a, b = n[here], s[here]
        if f < len(layout.cats):
            at = np.arange(size)
            low = np.zeros(size, bool)
            both = (a > 0) & (a < rows)
            low[both] = b[both] / a[both] < (errors - b[both]) / (rows - a[both])
            out.append((np.where(low, a, rows - a), np.where(low, b, errors - b), layout.starts[f] + at, np.full(size, f), at, low))
        else:
            feature = sum(layout.sizes) + f - len(layout.cats)
            at = np.arange(size - 1)
            out.append((np.cumsum(a)[:-1], np.cumsum(b)[:-1], np.full(size - 1, feature), np.full(size - 1, f), at, np.ones(size - 1, bool)))
    return [np.concatenate(x) for x in zip(*out)]


def _grow(binned: Binned, blocks: DataFrame, depth: int, factor: float) -> Tree:
    layout = binned.layout
    width = max(layout.bins)
    tree = _empty_tree(depth, width)
    open_nodes, known = [1], {}
    for level in range(max(depth, 1)):
        slots = np.full(2 ** (level + 1), -1)
        slots[open_nodes] = np.arange(len(open_nodes))
        found = blocks.coalesce(binned.tasks).mapInArrow(
            _level(layout, tree, level, slots, factor), "part int, at long, n binary, s binary, total binary").collect()
        found.sort(key=lambda r: (r["part"], r["at"]))  # sums do not depend on who came first
        shape = (len(open_nodes), layout.starts[-1])
        n, s = np.zeros(shape, np.int64), np.zeros(shape)
        total = np.zeros((len(open_nodes), 3))
        for r in found:
            n += np.frombuffer(r["n"], np.int64).reshape(shape)
            s += np.frombuffer(r["s"]).reshape(shape)
            total += np.frombuffer(r["total"]).reshape(-1, 3)
        if level == 0:
            known[1] = total[0, 1] / total[0, 0] if total[0, 0] else 0.0
        nxt = []
        for i, node in enumerate(open_nodes if depth else []):
            rows, errors, squares = total[i]
            left, sums, feature, column, code, low = _candidates(layout, n[i], s[i], (int(rows), errors))
            valid = (left > 0) & (left < rows)
            if not valid.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(valid, sums * sums / left + (errors - sums) ** 2 / (rows - left) - errors * errors / rows, -np.inf)
            if gain.max() <= EQUAL * squares:
                continue
            at = int(np.argmax(gain >= gain.max() - EQUAL * squares))
            f, size = int(column[at]), layout.bins[int(column[at])]
            codes = np.arange(size)
            goes_left = codes <= code[at] if f >= len(layout.cats) else (codes == code[at]) == bool(low[at])
            tree.column[node], tree.right[node, :size] = f, ~goes_left
            tree.splits.append((node, int(feature[at]), float(gain[at])))
            known[2 * node], known[2 * node + 1] = sums[at] / left[at], (errors - sums[at]) / (rows - left[at])
            nxt += [2 * node, 2 * node + 1]
        if not nxt:
            break
        open_nodes = nxt
    for node in range(1, 2 ** (depth + 1)):  # a leaf's value holds for whatever lies below it
        tree.value[node] = known[node] if node in known else tree.value[node // 2]
    # a split whose sides are leaves of one value is none
    inner = {node for node, _, _ in tree.splits}
    for node in sorted(inner, reverse=True):
        if 2 * node not in inner and 2 * node + 1 not in inner and known[2 * node] == known[2 * node + 1]:
            inner.discard(node)
    tree.splits = [x for x in tree.splits if x[0] in inner]
    return tree


@dataclass
class Model:
    """Trees and their weights; ``transform`` adds the prediction to rows with the columns that they were fitted on."""

    layout: Layout
    trees: list[Tree]
    weights: list[float]

    def predict(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(codes.shape[1])
        for at in range(0, len(out), BLOCK_ROWS):
            some = np.ascontiguousarray(codes[:, at : at + BLOCK_ROWS])
            for tree, weight in zip(self.trees, self.weights):
                out[at : at + BLOCK_ROWS] += weight * tree.value[tree.nodes(some)]
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        ship_package(df.sparkSession)
        layout, predict = self.layout, self.predict

        @F.pandas_udf("double")
        def predicted(x: pd.DataFrame) -> pd.Series:
            return pd.Series(predict(layout.codes([x[c].to_numpy(np.float64, na_value=np.nan) for c in x.columns])))

        return df.withColumn(out, predicted(F.struct(*[F.col(c).cast("double") for c in (*layout.cats, *layout.nums)])))

    @property
    def feature_importances(self) -> np.ndarray:
        """Each feature's share of the gains (times rows) of all splits, in the order of the one-hot vector."""
        sums = np.zeros(sum(self.layout.sizes) + len(self.layout.nums))
        for t in self.trees:
            for _, feature, gain in t.splits:
                sums[feature] += gain
        return sums / sums.sum() if sums.sum() else sums


def fit(binned: Binned, maxIter: int = 20, maxDepth: int = 5, stepSize: float = 0.1, subsamplingRate: float = 1.0, seed: int = 42) -> Model:
    """``maxIter`` trees on the rows of ``binned``: the first on the label, each later one on twice the errors so far."""
    blocks, trees, weights = binned.blocks, [], []
    for i in range(maxIter):
        if i:
            done = blocks
            blocks = done.mapInArrow(_advance(binned.layout, trees[-1], weights[-1]), _BLOCK).persist()
        grown_on = blocks.mapInArrow(_subsample(binned.layout, subsamplingRate, seed + i), _BLOCK).persist() if subsamplingRate < 1 else blocks
        trees.append(_grow(binned, grown_on, maxDepth, 2.0 if i else 1.0))
        if subsamplingRate < 1:
            grown_on.unpersist()
        weights.append(stepSize if i else 1.0)
        if i > 1:
            done.unpersist()  # the new errors are held: the first level has read them all
    if maxIter > 1:
        blocks.unpersist()
    return Model(binned.layout, trees, weights)
