"""Vector operators on ``array<float>`` embeddings.

Class centroids are an aggregate over (class, dimension) cells.  The k
centroids are gathered into one array used as a scalar subquery, so scoring every vector against every
centroid is a per-row ``transform``: no join and no pair rows.  Classes are a domain: their number is checked
before they are gathered, and more than ``MOST_CLASSES`` are an error, not a larger array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MOST_CLASSES = 4096


def dvec(c) -> Column:
    return F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def sqdist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def centroids(df: DataFrame, label: str, vec: str) -> DataFrame:
    """(label, n, centroid array<double>) per class."""
    cells = df.select(label, F.posexplode(vec).alias("d", "v")).groupBy(label, "d").agg(
        F.avg(F.col("v").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return cells.groupBy(label).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("d", "m"))).alias("s")
                                    ).select(label, "n", F.transform("s", lambda x: x["m"]).alias("centroid"))


def _bounded(cents: DataFrame, label: str) -> DataFrame:
    """``cents``, written once, if it has no more than ``MOST_CLASSES`` rows."""
    from mercato.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(cents.sparkSession)
    cents = cents.checkpoint()
    if len(cents.select(label).take(MOST_CLASSES + 1)) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    return cents


def centroid_array(cents: DataFrame, label: str) -> Column:
    """All centroids as one scalar array<struct<label, n, centroid>> (k entries, at most ``MOST_CLASSES``)."""
    return _bounded(cents, label).select(F.sort_array(F.collect_list(F.struct(label, "n", "centroid")))).scalar()


def nearest_centroid(df: DataFrame, key: str, label: str, vec: str) -> DataFrame:
    """Best cosine match per vector against the class centroids."""
    df = df.withColumn("_cents", centroid_array(centroids(df, label, vec), label))
    cents = F.col("_cents")
    v = dvec(vec)
    scored = F.transform(cents, lambda c: F.struct(cosine(v, c["centroid"]).alias("score"),
                                                   (-c[label]).alias("neg_label")))
    best = F.array_max(scored)
    own = F.filter(scored, lambda s: -s["neg_label"] == F.col(label))
    return df.select(key, label, (-best["neg_label"]).alias("nearest"), best["score"].alias("score"),
                     F.get(own, 0)["score"].alias("own_score"))


def cluster_indices(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Calinski-Harabasz and Davies-Bouldin indices for a given labelling."""
    cents_df = _bounded(centroids(df, label, vec), label)
    df = df.withColumn("_cents", centroid_array(cents_df, label))
    cents = F.col("_cents")
    v = dvec(vec)
    own = F.get(F.filter(cents, lambda c: c[label] == F.col(label)), 0)["centroid"]
    pts = df.select(label, F.sqrt(sqdist(v, own)).alias("dist"), sqdist(v, own).alias("sq"))
    spread = pts.groupBy(label).agg(F.avg("dist").alias("s"), F.sum("sq").alias("w"), F.count(F.lit(1)).alias("n"))
    base = spread.agg(F.sum("w").alias("W"), F.sum("n").alias("N"),
                      F.sort_array(F.collect_list(F.struct(label, "s"))).alias("spreads")
                      ).withColumn("_cents", centroid_array(cents_df, label))
    W, N, spreads = F.col("W"), F.col("N"), F.col("spreads")
    k = F.size(cents)
    dims = F.size(F.get(cents, 0)["centroid"])
    grand = F.transform(F.sequence(F.lit(0), dims - 1), lambda d: F.aggregate(
        cents, F.lit(0.0), lambda acc, c: acc + c["n"] * F.get(c["centroid"], d)) / N)
    B = F.aggregate(cents, F.lit(0.0), lambda acc, c: acc + c["n"] * sqdist(c["centroid"], grand))
    ch = (B / (k - 1)) / (W / (N - k))
    pair_ratio = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.array_max(F.transform(
        F.filter(F.sequence(F.lit(0), k - 1), lambda j: j != i),
        lambda j: (F.get(spreads, i)["s"] + F.get(spreads, j)["s"])
        / F.sqrt(sqdist(F.get(cents, i)["centroid"], F.get(cents, j)["centroid"])))))
    db = F.aggregate(pair_ratio, F.lit(0.0), lambda acc, x: acc + x) / k
    return base.select(F.round(ch, 6).alias("calinski_harabasz"), F.round(db, 6).alias("davies_bouldin"))


def cluster_sse(df: DataFrame, label: str, vec: str) -> DataFrame:
    """(label, n, sse): squared error of the vectors around their cluster's mean, from sums per cluster and dimension."""
    cells = df.select(label, F.posexplode(dvec(vec)).alias("d", "x")).groupBy(label, "d").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.sum(F.col("x") * F.col("x")).alias("q"))
    return cells.groupBy(label).agg(F.max("n").alias("n"), F.sum(F.col("q") - F.col("n") * F.col("m") * F.col("m")).alias("sse"))


def ward_merge_costs(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Ward merge cost n_a n_b / (n_a + n_b) * |m_a - m_b|^2 for each class pair."""
    cents = _bounded(centroids(df, label, vec), label)
    arr = cents.select(F.sort_array(F.collect_list(F.struct(label, "n", "centroid"))).alias("cs"))
    a = arr.select(F.posexplode("cs").alias("i", "a"), "cs")
    b = a.select("i", "a", F.posexplode("cs").alias("j", "b")).filter(F.col("i") < F.col("j"))
    na, nb = F.col("a.n").cast("double"), F.col("b.n").cast("double")
    delta = na * nb / (na + nb) * sqdist(F.col("a.centroid"), F.col("b.centroid"))
    return b.select(F.col(f"a.{label}").alias("label_a"), F.col(f"b.{label}").alias("label_b"),
                    F.round(delta, 6).alias("ward_delta"))
