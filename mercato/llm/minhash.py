"""Near-duplicate groups by min-max hashing.

A document's set is its distinct shingles of ``k`` words (a shorter text: its whole sequence).  Every
permutation of the hash range gives two signature values, the smallest and the largest permuted hash, so
``bands * rows`` values cost half as many permutations.  Values are banded: two sets whose bands of ``rows``
values agree anywhere are candidates.  With Jaccard s a pair is missed with probability about
(1 - s**rows)**bands: 7e-9 at 0.85 with 32 bands of 5, 1e-7 at 0.8 with 40.

Only different sets are compared: documents with equal sets form a class first.  Links are confirmed on
full sets, and only as many as the groups need, never all pairs of a bucket:

1. in every bucket the members are compared with two hubs (its smallest and largest class);
2. confirmed links give components (large-star / small-star rounds);
3. a bucket whose members lie in one component is settled; in the others, every member outside the
   bucket's largest component is compared with the members of other components.  Every candidate pair
   then either lies in one component or was compared, and the links found join components once more.
   Where that would be many pairs (a large group of texts that are similar, but not enough), buckets that
   overlap are merged and compared block by block: a task takes two blocks of sets, counts all common
   shingles by a matrix product, and returns only the links.

So two classes that are candidates and alike always end in one component.  Texts are shuffled only for
classes that have candidates; hot hubs are split by Spark's skewed joins.

Defined cases: null or empty texts and texts without words have no shingles and no links; null ids are kept
and linked with nothing; rows that repeat an id are one document,
linked by any of its texts; empty tables give no rows.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import has_rows, saved
from mercato.llm.shingles import mix, shingle_sets

#: Shingles permuted at once.
CHUNK = 1 << 14


class MinMax:
    """``bands * rows`` signature values from half as many permutations; smallest and largest value of one
    permutation never share a band."""

    def __init__(self, bands: int, rows: int, seed: int = 7) -> None:
        if bands % 2:
            raise ValueError("bands must be even: half hold minima, half maxima")
        n = bands // 2 * rows
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = rng.integers(0, 2**63, n, dtype=np.uint64)
        self.bands, self.rows = bands, rows

    def signature(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.full(len(self.factor), np.iinfo(np.uint64).max, dtype=np.uint64)
        high = np.zeros(len(self.factor), dtype=np.uint64)
        for i in range(0, len(shingles), CHUNK):
            x = shingles[None, i : i + CHUNK] * self.factor[:, None] + self.shift[:, None]
            np.minimum(low, x.min(axis=1), out=low)
            np.maximum(high, x.max(axis=1), out=high)
        return low, high

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        low, high = self.signature(shingles)
        values = np.concatenate((low, high)).reshape(self.bands, self.rows)
        key = mix(np.arange(1, self.bands + 1, dtype=np.uint64))
        for r in range(self.rows):
            key = mix(key ^ values[:, r])
        return key.view(np.int64)


def _sign(k: int, bands: int, rows: int):
    def run(batches):
        family = MinMax(bands, rows)
        for b in batches:
            sizes, ones, twos, keys, counts = [], [], [], [], []
            for s in shingle_sets(b.column(1).to_pylist(), k):
                sizes.append(len(s))
                if len(s):
                    ones.append(int(np.bitwise_xor.reduce(mix(s)).view(np.int64)))
                    twos.append(int(np.add.reduce(mix(s ^ np.uint64(0x5BD1E995))).view(np.int64)))
                    keys.append(family.band_keys(s))
                    counts.append(bands)
                else:
                    ones.append(None)
                    twos.append(None)
                    counts.append(0)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "n_shingles", "s1", "s2", "bands"])

    return run


def _confirm(k: int, percent: int):
    """Compare the sets of two texts; the last left set is remembered, as pairs come sorted by it."""
    def run(batches):
        last, held = None, None
        for b in batches:
            a, c, ta, tc = (b.column(n) for n in ("a", "c", "ta", "tc"))
            out_a, out_c = [], []
            for i in range(b.num_rows):
                x, y = a[i].as_py(), c[i].as_py()
                if x != last:
                    last, held = x, next(shingle_sets([ta[i].as_py()], k))
                other = next(shingle_sets([tc[i].as_py()], k))
                both = len(np.intersect1d(held, other, assume_unique=True))
                if 100 * both >= percent * (len(held) + len(other) - both):
                    out_a.append(x)
                    out_c.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_c, pa.int64())], names=["a", "c"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, c) whose texts' full sets reach the similarity."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("c"), F.col("text").alias("tc"))
    both = pairs.join(right, "c").join(left, "a").select("a", "c", "ta", "tc")
    return saved(both.mapInArrow(_confirm(k, percent), "a bigint, c bigint"), "minhash-links")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, c): the smallest id reachable.

    Large-star and small-star rounds; each round is written to the shared folder.  They end as soon as the
    links are stars, which one shuffle of the ends tells without another round."""
    e = saved(edges.filter("a <> c").select(F.greatest("a", "c").alias("u"), F.least("a", "c").alias("v")).distinct(),
              "links")
    while not _stars(e):
        # large star: a node's larger neighbours go to the smallest node around it
        around = e.select("u", "v").union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        low = around.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = around.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(
            low.select("u", F.col("m").alias("v"))).distinct()
        e = saved(small, "links")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component")))


def _stars(e: DataFrame) -> bool:
    """Whether every larger end of ``e`` (u > v) has one link and is the smaller end of none."""
    ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up")),
                                      F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("n")).select("n.*")
    odd = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter("ups > 1 or ups = 1 and least = 0")
    return not has_rows(odd)


def _grouped(source: DataFrame, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``source`` (id, text; an id stands for one text) as id, n_shingles, component (smallest id reachable over links of at
    least ``percent`` % similarity) and class (smallest id with the same set), both null without an id."""
    signed = saved(source.mapInArrow(_sign(k, bands, rows),
                                     "id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>"),
                   "minhash-signatures")
    sets = ["n_shingles", "s1", "s2"]
    present = signed.filter("n_shingles > 0 and id is not null")
    classes = saved(present.groupBy(*sets).agg(F.min("id").alias("class"), F.first("bands").alias("bands")), "minhash-classes")
    member = classes.select(F.col("class").alias("id"), F.explode("bands").alias("band"), "n_shingles")
    hubs = (member.groupBy("band").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi"))
    # buckets with more than one class; everything later reads these rows alone
    buckets = saved(member.join(hubs, "band"), "minhash-buckets")
    sizes = classes.select(F.col("class").alias("id"), "n_shingles")
    texts = saved(source.join(buckets.select("id").distinct(), "id", "left_semi"), "minhash-texts")
    star = buckets.select(F.explode(F.array(
        F.struct(F.col("lo").alias("a"), F.col("id").alias("c")), F.struct(F.col("id").alias("a"), F.col("hi").alias("c")),
    )).alias("p")).select("p.*").filter("a <> c").distinct()
    tried = saved(_possible(star, sizes, percent), "minhash-pairs")
    links = confirmed(tried, texts, k, percent)
    found = saved(components(links), "minhash-components")
    open_ = saved(_unsettled(buckets, found), "minhash-open")
    rest = saved(_pairs(open_.filter(~F.col("many")), tried, percent), "minhash-pairs")
    more = confirmed(rest, texts, k, percent).unionByName(_blocks(open_.filter("many"), texts, k, percent))
    if has_rows(more):
        found = saved(components(links.unionByName(more)), "minhash-components")
    named = classes.join(found.withColumnRenamed("id", "class"), "class", "left").select(
        *sets, "class", F.coalesce("component", "class").alias("component"))
    keys = [signed[c].eqNullSafe(named[c]) for c in sets]
    out = signed.join(named, keys[0] & keys[1] & keys[2], "left")
    return out.select("id", signed["n_shingles"], F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
                      F.when(F.col("id").isNotNull(), F.coalesce("class", "id")).alias("class"))


def _texts_of_ids(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``_n_real`` (the id) and ``_n_id`` (what stands for the text): the id itself, or, where an id repeats with
    other texts, a negative number made of the id and the text.  Beside it the pairs of both for such ids, if any."""
    rows = docs.withColumn("_n_real", F.col(key).cast("long")).withColumn("_n_text", F.xxhash64(F.lit(7), F.col(text)))
    several = rows.filter("_n_real is not null").groupBy(F.col("_n_real").alias("_n_several")).agg(
        F.min("_n_text").alias("lo"), F.max("_n_text").alias("hi")).filter("lo <> hi").select("_n_several")
    several = saved(several, "minhash-ids")
    if not has_rows(several):
        return rows.withColumn("_n_id", F.col("_n_real")).drop("_n_text"), None
    made = -F.shiftrightunsigned(F.xxhash64("_n_real", "_n_text"), 2) - 2
    rows = rows.join(several, F.col("_n_real") == F.col("_n_several"), "left").withColumn(
        "_n_id", F.when(F.col("_n_several").isNull(), F.col("_n_real")).otherwise(made))
    pairs = saved(rows.filter("_n_several is not null").select("_n_id", "_n_real").distinct(), "minhash-ids")
    return rows.drop("_n_text", "_n_several"), pairs


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, bands: int = 40,
           rows: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable over links of at least
    ``percent`` % similarity), class_id (smallest id with the same set), kept.  Rows of one id are one document, which
    all its texts link."""
    source, several = _texts_of_ids(docs.select(key, text), key, text)
    out = _grouped(source.select(F.col("_n_id").alias("id"), F.col(text).alias("text")), k, percent, bands, rows)
    if several is not None:
        out = _united(saved(out, "minhash-groups"), several)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("class").alias("class_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _united(out: DataFrame, several: DataFrame) -> DataFrame:
    """``out`` by real ids: components that hold texts of one id become one, named by its smallest real id."""
    named = out.join(several, F.col("id") == F.col("_n_id"), "left").select(
        "id", F.coalesce("_n_real", "id").alias("real"), "n_shingles", "component", "class")
    hub = several.groupBy(F.col("_n_real").alias("_n_of")).agg(F.min("_n_id").alias("c"))
    edges = out.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("c")).union(
        several.join(hub, F.col("_n_real") == F.col("_n_of")).select(F.col("_n_id").alias("a"), "c"))
    whole = components(edges).select(F.col("id").alias("_n_node"), F.col("component").alias("_n_whole"))
    named = saved(named.join(whole, F.col("id") == F.col("_n_node"), "left").withColumn(
        "_n_whole", F.coalesce("_n_whole", "id")), "minhash-groups")
    least = named.groupBy(F.col("_n_whole").alias("_n_w")).agg(F.min("real").alias("component"))
    same = named.groupBy(F.col("class").alias("_n_c")).agg(F.min("real").alias("class"))
    return named.drop("component").join(least, F.col("_n_whole") == F.col("_n_w"), "left").withColumnRenamed(
        "class", "_n_class").join(same, F.col("_n_class") == F.col("_n_c"), "left").select(
        F.col("real").alias("id"), "n_shingles", "component", "class")


def _possible(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, c) whose set sizes allow the similarity."""
    p = pairs.join(sizes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na")), "a").join(
        sizes.select(F.col("id").alias("c"), F.col("n_shingles").alias("nc")), "c")
    return p.filter(100 * F.least("na", "nc") >= percent * F.greatest("na", "nc")).select("a", "c")


#: Pairs of one bucket above which it is compared block by block, and the sets in a block.
MANY_PAIRS = 300
BLOCK = 512


def _unsettled(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: band, id, component, top (the bucket's largest
    component) and many (whether its pairs are compared block by block)."""
    b = buckets.select("band", "id", "n_shingles").join(found, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    shares = b.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    top = shares.groupBy("band").agg(F.max(F.struct("n", "component")).alias("t"), F.sum("n").alias("all"),
                                     F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    top = top.select("band", F.col("t.component").alias("top"),
                     ((F.col("all") - F.col("t.n")) * F.col("all") > MANY_PAIRS).alias("many"))
    return b.join(top, "band")


def _pairs(b: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components not compared yet: members outside their bucket's largest component
    against members of other components."""
    x = b.filter("component <> top").select("band", F.col("id").alias("x"), F.col("component").alias("cx"),
                                            F.col("n_shingles").alias("nx"))
    y = b.select("band", F.col("id").alias("y"), F.col("component").alias("cy"), F.col("n_shingles").alias("ny"))
    pairs = x.join(y, "band").filter((F.col("cx") != F.col("cy")) & (
        100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")))
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("c")).distinct()
    return pairs.join(tried, ["a", "c"], "left_anti")


def _compare(k: int, percent: int):
    """Links between the sets of side 0 and side 1 of one pair of blocks."""
    def run(t: pa.Table) -> pa.Table:
        side, ids, comp = (np.asarray(t.column(n)) for n in ("side", "id", "component"))
        sets = list(shingle_sets(t.column("text").to_pylist(), k))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        out_a, out_c = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(left) and len(right):
            shared = np.intersect1d(np.unique(np.concatenate([sets[i] for i in left])),
                                    np.unique(np.concatenate([sets[i] for i in right])), assume_unique=True)
            both = np.zeros((len(left), len(right)), dtype=np.float32)
            for at in range(0, len(shared), 4096):
                part = shared[at : at + 4096]
                x, y = (np.stack([np.isin(part, sets[i], assume_unique=True) for i in rows]).astype(np.float32)
                        for rows in (left, right))
                both += x @ y.T
            both = np.rint(both).astype(np.int64)
            union = sizes[left][:, None] + sizes[right][None, :] - both
            hit = (100 * both >= percent * union) & (comp[left][:, None] != comp[right][None, :])
            i, j = np.nonzero(hit)
            u, v = ids[left[i]], ids[right[j]]
            out_a, out_c = np.minimum(u, v), np.maximum(u, v)
        return pa.table({"a": pa.array(out_a, pa.int64()), "c": pa.array(out_c, pa.int64())})

    return run


def _blocks(b: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between components inside merged buckets, found block by block."""
    schema = "a bigint, c bigint"
    if not has_rows(b):
        return b.sparkSession.createDataFrame([], schema)
    low = b.groupBy("band").agg(F.min("id").alias("c"))
    merged = components(b.join(low, "band").select(F.col("id").alias("a"), "c"))
    m = b.select("id", "component").distinct().join(merged.withColumnRenamed("component", "g"), "id")
    shares = m.groupBy("g", "component").agg(F.count(F.lit(1)).alias("n"))
    tops = shares.groupBy("g").agg(F.max(F.struct("n", "component")).alias("t"), F.sum("n").alias("all"))
    m = m.join(tops.select("g", F.col("t.component").alias("top"), F.ceil(F.col("all") / BLOCK).cast("int").alias("ny"),
                           F.ceil((F.col("all") - F.col("t.n")) / BLOCK).cast("int").alias("nx")), "g")
    m = m.withColumn("h", F.xxhash64("id"))
    left = m.filter("component <> top").select("g", "id", "component", F.lit(0).alias("side"),
                                               F.pmod("h", "nx").alias("bx"), F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("by"))
    right = m.select("g", "id", "component", F.lit(1).alias("side"),
                     F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("bx"), F.pmod("h", "ny").alias("by"))
    grid = left.select("g", "bx", "by", "side", "id", "component").unionByName(
        right.select("g", "bx", "by", "side", "id", "component")).join(texts, "id")
    return saved(grid.groupBy("g", "bx", "by").applyInArrow(_compare(k, percent), schema), "minhash-links")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, bands: int = 40,
             rows: int = 5) -> DataFrame:
    """The rows of ``docs`` (its columns unchanged) without those whose text's group has a smaller id.

    An id that repeats with other texts stands for each of them apart, so of every group of like texts the text of the
    smallest id stays.  Rows that repeat the kept id and text all stay; rows without an id stay."""
    source, several = _texts_of_ids(docs, key, text)
    g = _grouped(source.select(F.col("_n_id").alias("id"), F.col(text).alias("text")), k, percent, bands, rows)
    g = g.filter("id is not null").select("id", "component").distinct()
    if several is None:
        gone = g.filter("id <> component")
    else:
        g = saved(g.join(several, F.col("id") == F.col("_n_id"), "left").select("id", "component", F.struct(
            F.coalesce("_n_real", "id").alias("real"), "id").alias("place")), "minhash-groups")
        first = g.groupBy(F.col("component").alias("_n_c")).agg(F.min("place").alias("first"))
        gone = g.join(first, F.col("component") == F.col("_n_c")).filter("place <> first")
    return source.join(gone.select(F.col("id").alias("_n_gone")), F.col("_n_id") == F.col("_n_gone"), "left_anti").select(*docs.columns)
