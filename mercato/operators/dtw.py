"""Dynamic time warping: distances, bounds and k-medoids clustering of series.

A task aligns all series of an Arrow batch with one medoid at a time: each step of the dynamic programme is an array
operation over the batch.  Keogh's bound (how far a series leaves the medoid's envelope) comes first, and only
series whose bound beats their best distance so far are aligned.  Series are short (bounded by the calendar) and of equal
length; k medoids and ``candidates`` series per cluster reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir


def dtw_batch(series: np.ndarray, other: np.ndarray, band: int, gamma: float = 0.0) -> np.ndarray:
    """Distance of each row of ``series`` to ``other`` within a Sakoe-Chiba band: the root of the summed squared steps, or,
    with ``gamma`` > 0, soft-DTW (squared steps, soft minimum)."""
    rows, n = series.shape
    m = len(other)
    band = max(band, abs(n - m))
    out = np.empty(rows)
    for at in range(0, rows, ALIGNED):
        out[at : at + ALIGNED] = _last_cells(np.ascontiguousarray(series[at : at + ALIGNED].T), np.asarray(other), band, gamma)
    return out if gamma > 0 else np.sqrt(out)


#: Series aligned together: the programme's two rows for them stay in a core's cache.
ALIGNED = 2048


def _last_cells(steps: np.ndarray, other: np.ndarray, band: int, gamma: float) -> np.ndarray:
    """The programme's last cell for each column of ``steps``: two of its rows are held, each cell a run of all series."""
    n, rows = steps.shape
    m = len(other)
    before, now = np.full((m + 1, rows), np.inf), np.full((m + 1, rows), np.inf)
    before[0] = 0.0
    for i in range(1, n + 1):
        lo, hi = max(1, i - band), min(m, i + band)
        now[lo - 1] = np.inf
        now[hi + 1 : hi + 2] = np.inf
        step = (steps[i - 1] - other[lo - 1 : hi, None]) ** 2
        if gamma > 0:
            for j in range(lo, hi + 1):
                ways = np.stack((before[j], before[j - 1], now[j - 1]))
                best = ways.min(axis=0)
                with np.errstate(invalid="ignore"):
                    best = best - gamma * np.log(np.exp(-(ways - best) / gamma).sum(axis=0))
                now[j] = step[j - lo] + best
        else:
            straight = np.minimum(before[lo : hi + 1], before[lo - 1 : hi])
            for j in range(lo, hi + 1):
                np.minimum(straight[j - lo], now[j - 1], out=now[j])
                now[j] += step[j - lo]
        before, now = now, before
    return before[m]


def keogh_bound(series: np.ndarray, other: np.ndarray, band: int) -> np.ndarray:
    """A lower bound of ``dtw_batch`` (gamma 0, equal lengths): what sticks out of the other's envelope."""
    n = len(other)
    high = np.array([other[max(0, i - band) : i + band + 1].max() for i in range(n)])
    low = np.array([other[max(0, i - band) : i + band + 1].min() for i in range(n)])
    out = np.maximum(series - high, 0.0) + np.maximum(low - series, 0.0)
    return np.sqrt((out * out).sum(axis=1))


def nearest(series: np.ndarray, medoids: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and distance of each row's nearest medoid (the first on ties), and how many alignments it took."""
    bounds = np.stack([keogh_bound(series, m, band) for m in medoids], axis=1)
    best, where, aligned = np.full(len(series), np.inf), np.zeros(len(series), np.int64), 0
    for j, m in enumerate(medoids):
        todo = np.flatnonzero(bounds[:, j] <= best)
        if len(todo):
            d = dtw_batch(series[todo], m, band)
            aligned += len(todo)
            closer = d < best[todo]
            best[todo[closer]], where[todo[closer]] = d[closer], j
    return where, best, aligned


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def assign(df: DataFrame, key: str, series: str, medoids: list[tuple[int, list[float]]], band: int) -> DataFrame:
    """(key, series, medoid, distance): every series with its nearest medoid."""
    ids, shapes = np.array([m[0] for m in medoids]), np.array([m[1] for m in medoids], dtype=float)

    def run(batches):
        for b in batches:
            if b.num_rows:
                where, best, _ = nearest(_matrix(b.column(1)), shapes, band)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids[where], pa.int64()), pa.array(best)],
                                                 names=[key, series, "medoid", "distance"])

    return df.select(F.col(key).cast("bigint").alias(key), F.col(series).cast("array<double>").alias(series)).mapInArrow(
        run, f"{key} bigint, {series} array<double>, medoid bigint, distance double")


def _costs(assigned: DataFrame, key: str, series: str, candidates: dict[int, list[tuple[int, list[float]]]], band: int) -> DataFrame:
    """(medoid, candidate, cost): summed distances of all members of a cluster to each of its candidates."""

    def run(batches):
        totals: dict[tuple[int, int], float] = {}
        for b in batches:
            if not b.num_rows:
                continue
            rows, own = _matrix(b.column(0)), b.column(1).to_numpy()
            for medoid, found in candidates.items():
                members = rows[own == medoid]
                for cid, shape in found if len(members) else ():
                    d = dtw_batch(members, np.array(shape, dtype=float), band)
                    totals[medoid, cid] = totals.get((medoid, cid), 0.0) + float(d.sum())
        keys = list(totals)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                                          pa.array([totals[k] for k in keys], pa.float64())], names=["medoid", "candidate", "cost"])

    sums = assigned.select(series, "medoid").mapInArrow(run, "medoid bigint, candidate bigint, cost double")
    return sums.groupBy("medoid", "candidate").agg(F.round(F.sum("cost"), 9).alias("cost"))


def k_medoids(df: DataFrame, key: str, series: str, k: int, band: int, candidates: int = 8, rounds: int = 6, seed: int = 5) -> DataFrame:
    """(key, medoid, distance) after alternating assignment and medoid update until the total no longer falls.

    The first medoids are chosen far apart (each the series farthest from the ones before, the first by a seeded hash).
    A cluster's new medoid is the best of ``candidates`` members, half the nearest to the old one and half by
    a hash that changes with the round; a candidate's cost covers all members."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(F.col(key).cast("bigint").alias(key), F.col(series).cast("array<double>").alias(series)).checkpoint()
    first = df.orderBy(F.xxhash64(key, F.lit(seed)), key).first()
    if first is None:
        return df.select(key, F.lit(None).cast("bigint").alias("medoid"), F.lit(None).cast("double").alias("distance"))
    medoids = [(first[0], first[1])]
    while len(medoids) < k:
        far = assign(df, key, series, medoids, band).orderBy(F.desc("distance"), key).first()
        if far["distance"] == 0:
            break
        medoids.append((far[key], far[series]))
    held = assign(df, key, series, medoids, band).checkpoint()
    total = held.agg(F.sum("distance")).first()[0]
    for round_ in range(rounds):
        half = max(1, candidates // 2)
        one = F.struct(F.col(key).alias("id"), F.col(series).alias("s"))
        # the few nearest and the few of lowest hash per cluster: each task keeps its own few before the shuffle
        picked = {}
        for rank in (F.col("distance"), F.xxhash64(key, F.lit(round_))):
            for m, _ in medoids:
                for r in held.filter(F.col("medoid") == m).orderBy(rank, key).limit(half).select(one.alias("c")).collect():
                    picked.setdefault(m, {})[r["c"]["id"]] = r["c"]["s"]
        sums = _costs(held, key, series, {m: sorted(c.items()) for m, c in picked.items()}, band)
        best = {r["medoid"]: r["b"] for r in sums.groupBy("medoid").agg(F.min(F.struct("cost", "candidate")).alias("b")).collect()}
        medoids = [(best[m]["candidate"], picked[m][best[m]["candidate"]]) for m in sorted(best)]
        again = assign(df, key, series, medoids, band).checkpoint()
        new = again.agg(F.sum("distance")).first()[0]
        if new >= total:
            break
        held, total = again, new
    return held.select(key, "medoid", "distance")
