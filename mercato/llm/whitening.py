"""Whitening of embeddings by shifted CholeskyQR.

Each finite entry c of a vector becomes the whole number x = floor(scale * c) + offset.  With n vectors and the
per-dimension sums S, the centred rows are x - S/n with the whole part of S/n taken off in whole numbers, so nothing cancels.  Each Gram
pass sums Q'Q over the partitions (one d x d matrix a partition, added up by row of the matrix in a shuffle),
takes the Cholesky factor of the sum plus a small shift on the driver and gives the next Q = Q inv(R) by
triangular solves in the tasks.  Passes end when Q'Q no longer moves towards the identity.  The composed
R = Rk ... R1 and the last Gram matrix G (close to the identity, but for dimensions that depend on others)
give the rows' scatter as (sqrt(G) R)'(sqrt(G) R); an SVD of that small matrix yields the components.  Only
d x d matrices reach the driver (d is the dimension of the vectors, ``MAX_DIM`` at most; more is an error).

Defined cases: a null vector and one with a null, NaN or infinite entry, or one beyond ``LARGEST``, is dropped; so
is one whose length differs from the most frequent length (the smaller on ties) and an empty one.  Null, repeated
and tied ids are carried along.  A component without variance (at most ``RANK`` of the largest standard deviation)
has ``whitened`` null and counts for no identity error; an empty table gives no rows.  ``deviation`` is null where it
exceeds a long.  Equal eigenvalues share a space; any of its bases may come out.  The sign makes each component's
largest entry positive.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
PASSES = 6
MAX_DIM = 4096
RANK = 1e-11
LARGEST = 2.0**30
BLOCK = 4096

OUT = ("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows that count, as (the key's column, ``_w_v`` array<double>), and their length; one job finds it."""
    v = F.col(vector)
    fine = F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.exists(
        v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(LARGEST)))
    rows = vectors.filter(fine).select(F.col(key), v.cast("array<double>").alias("_w_v"))
    usual = rows.groupBy(F.size("_w_v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = usual["d"] if usual else 0
    if dim > MAX_DIM:
        raise ValueError(f"vectors have {dim} dimensions, at most {MAX_DIM} are taken")
    return rows.filter(F.size("_w_v") == dim), dim


def _whole(column: pa.Array, scale: int, offset: int) -> np.ndarray:
    """The x-vectors of one Arrow column of equally long lists, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.reshape(len(column), -1)).astype(np.int64) + offset


def _solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``a inv(R)`` for each upper triangular factor in turn, by forward substitution over all rows at once.
    Columns without a pivot stay zero."""
    for r in factors:
        q = np.zeros_like(a)
        for j in range(a.shape[1]):
            if r[j, j] > 0:
                q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        a = q
    return a


def _summed(rows: DataFrame, matrix_of, width: int, kind: str = "double") -> list[list]:
    """The sum over all rows of the matrix (``width`` columns) that ``matrix_of`` returns for a block of vectors: partial
    sums per task, added by row of the matrix in a shuffle, so that what the driver reads does not depend on the number
    of tasks.  Empty without vectors."""

    def run(batches):
        total = None
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = matrix_of(b.column(0).slice(at, BLOCK))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.from_numpy_dtype(total.dtype)))],
                names=["i", "v"])

    parts = rows.select("_w_v").mapInArrow(run, f"i int, v array<{kind}>")
    exact = "decimal(19,0)" if kind == "bigint" else kind
    summed = parts.groupBy("i").agg(F.array(*[F.sum(F.get("v", F.lit(j)).cast(exact)) for j in range(width)]).alias("v"))
    return [r["v"] for r in sorted(summed.collect(), key=lambda r: r["i"])]


def _centred(column: pa.Array, n: int, sums: list[int], scale: int, offset: int) -> np.ndarray:
    whole = np.array([t // n for t in sums])
    return (_whole(column, scale, offset) - whole) - np.array([t % n for t in sums]) / n


def fit(rows: DataFrame, d: int, scale: int = SCALE, offset: int = OFFSET, components: int = COMPONENTS,
        passes: int = PASSES) -> dict | None:
    """n, sums S, eigenvalues and unit components (rows) of the vectors of ``usable``; None without vectors."""
    tallied = _summed(rows, lambda c: np.concatenate(
        [[len(c)], _whole(c, scale, offset).sum(axis=0)]).reshape(-1, 1), 1, "bigint")
    if not tallied:
        return None
    n, *sums = (int(t[0]) for t in tallied)
    factors: list[np.ndarray] = []

    def gram() -> np.ndarray:
        def of(c: pa.Array) -> np.ndarray:
            q = _solved(_centred(c, n, sums, scale, offset), factors)
            return q.T @ q

        g = np.array(_summed(rows, of, d))
        return (g + g.T) / 2

    g = gram()
    trace = float(np.trace(g))
    composed, off = np.eye(d), np.inf
    for k in range(passes if trace else 0):
        now = float(np.abs(g - np.diag((np.diag(g) > 0.5).astype(float))).max()) if k else np.inf
        if now < 1e-14 * d or now >= off / 2 < np.inf:
            break
        off = now
        # the shift keeps the factor of a singular matrix real; it is of the size of the sums' rounding
        shift = 11 * (d + 1) * np.finfo(float).eps * float(np.trace(g)) / (d if k else 1)
        r = np.linalg.cholesky(g + shift * np.eye(d)).T
        factors.append(r)
        composed = r @ composed
        g = gram()
    weights, basis = np.linalg.eigh(g)
    root = np.sqrt(np.clip(weights, 0, None))[:, None] * basis.T
    _, sigma, vt = np.linalg.svd(root @ composed)
    vt = vt * np.where(vt[np.arange(d), np.abs(vt).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    k = min(components, d)
    alive = (sigma > RANK * sigma[0]) if trace else np.zeros(d, bool)
    return {"n": n, "sums": sums, "trace": trace / n, "eigenvalues": np.where(alive, sigma**2 / n, 0.0)[:k],
            "components": vt[:k], "passes": len(factors)}


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET,
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: its key and the columns of ``OUT``.

    The vectors are read once per pass; no row is shuffled.  Rows go to tasks as they are stored, so no key
    or repeated vector can gather in one task."""
    rows, d = usable(vectors, key, vector)
    model = fit(rows, d, scale, offset, components) if d else None
    id_type = rows.schema[0].dataType.simpleString()
    if model is None:
        return rows.sparkSession.createDataFrame([], f"`{key}` {id_type}, {OUT}")
    n, sums, e, v = model["n"], model["sums"], model["eigenvalues"], model["components"]
    k, alive = len(e), e > 0
    over = np.where(alive, 1 / np.sqrt(np.where(alive, e, 1.0)), 0.0)

    def project(column: pa.Array) -> np.ndarray:
        return _centred(column, n, sums, scale, offset) @ v.T * over

    def moments(column: pa.Array) -> np.ndarray:
        z = np.hstack([project(column), np.ones((len(column), 1))])
        return z.T @ z

    seen = np.array(_summed(rows, moments, k + 1)) / n
    live = np.flatnonzero(alive)
    # the rows are centred before; what rounding left of their means is taken off here
    cov = (seen[:k, :k] - np.outer(seen[:k, k], seen[:k, k]))[np.ix_(live, live)]
    error = float(np.abs(cov - np.eye(len(live))).max()) if len(live) else None
    explained = [float(x / model["trace"]) if model["trace"] > 0 else None for x in e]

    def squares(column: pa.Array) -> list:
        """The exact sums of (n*x - S)^2, null beyond a long."""
        off = _whole(column, scale, offset) - np.array([t // n for t in sums])
        rest = np.array([t % n for t in sums])
        if (n * (int(np.abs(off).max()) + 1)) ** 2 * d < 2**63:
            return ((n * off - rest) ** 2).sum(axis=1).tolist()
        exact = (sum((n * x - t) ** 2 for x, t in zip(row, rest.tolist())) for row in off.tolist())
        return [t if t < 2**63 else None for t in exact]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                ids, column = b.column(0).slice(at, BLOCK), b.column(1).slice(at, BLOCK)
                m = len(column)
                if not m:
                    continue
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array([n] * (m * k), pa.int64()),
                    pa.array(squares(column), pa.int64()).take(each),
                    pa.array(project(column).ravel(), mask=np.tile(~alive, m)),
                    pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"`{key}` {id_type}, {OUT}")
