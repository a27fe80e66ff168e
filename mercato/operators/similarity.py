"""Exact groups of similar sets: a prefix-filter join that finds components, not pairs.

Documents with equal sets form a class, named by its smallest id; everything else looks at one set per class.  Shingles
are ordered by how many classes have them.  Two sets of Jaccard similarity t share one of the rarest
n - ceil(n * t) + 1 shingles of each, so those prefixes meet every similar pair in a bucket.  In a bucket each member is
compared with the smallest and the largest one; confirmed links give components (alternating star rounds); buckets
that still hold several components then compare the members of different components.  Links are confirmed on whole
sets.  So no link between different sets is lost, and a large group of alike sets costs a number of comparisons that
grows with its size, not its square.

Shingles are shuffled by shingle once, a slice of all of them at a time, and counted where they arrive; those of one class
only go no further.  Every intermediate is written to the checkpoint folder, so that it is computed once and survives a lost
executor; its shuffle files go as soon as it is written.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.textops import words
from mercato.session import scratch_path


#: Slices of the shingles that are shuffled one after the other.
SLICES = 4


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back; the shuffle files of ``df`` go as soon as it is written."""
    path = scratch_path(df.sparkSession, f"similarity/{name}-{uuid.uuid4().hex}")
    key, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", df.sparkSession.conf
    before = conf.get(key)
    conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def some(df: DataFrame) -> bool:
    return len(df.take(1)) > 0


def shingle_arrays(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """(key, sh): the distinct hashes of the runs of ``k`` words of each text, ascending; a shorter text gives its whole
    word sequence as one, a text without words none.  All in the row."""
    x = df.select(key, words(F.col(text)).alias("_w"))
    size = F.size("_w")
    zipped = F.arrays_zip(*[F.slice("_w", i + 1, F.greatest(size - i, F.lit(1))).alias(f"w{i}") for i in range(k)])
    runs = F.slice(zipped, 1, F.greatest(size - k + 1, F.lit(1)))
    hashed = F.transform(runs, lambda z: F.xxhash64(*[z[f"w{i}"] for i in range(k)]))
    none = F.array().cast("array<bigint>")
    sh = F.when(size >= k, F.array_sort(F.array_distinct(hashed))).when(size > 0, F.array(F.xxhash64(F.lit(k), "_w"))).otherwise(none)
    return x.select(key, sh.alias("sh"))


def star_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (a, c), for every end of one."""
    e = saved(edges.filter("a <> c").select(F.greatest("a", "c").alias("hi"), F.least("a", "c").alias("lo")).distinct(), "edges")
    while True:
        ends = e.select(F.inline(F.array(F.struct(F.col("hi").alias("id"), F.lit(1).alias("up")),
                                         F.struct(F.col("lo").alias("id"), F.lit(0).alias("up")))))
        # done when each larger end has one link and is the smaller end of none
        if not some(ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter("ups > 1 or (ups = 1 and least = 0)")):
            break
        both = e.select(F.col("hi").alias("id"), F.col("lo").alias("of")).unionAll(e.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("id").agg(F.min("of").alias("m")).select("id", F.least("id", "m").alias("m"))
        up = both.join(least, "id").filter("of > id").select(F.col("of").alias("id"), "m")
        down = up.groupBy("id").agg(F.min("m").alias("least"))
        e = saved(up.join(down, "id").filter("m <> least").select(F.col("m").alias("hi"), F.col("least").alias("lo")).unionAll(
            down.select(F.col("id").alias("hi"), F.col("least").alias("lo"))).distinct(), "edges")
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionAll(
        e.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


def similar_groups(df: DataFrame, key: str, text: str, k: int = 5, percent: int = 70) -> DataFrame:
    """(key, class_id, component_id) for every document: the smallest id with an equal set, and the smallest id reachable
    over links of at least ``percent`` % Jaccard similarity.  Texts without words are alone; null ids have neither."""
    source = df.select(F.col(key).cast("bigint").alias("id"), text)
    # the texts are read once; every later step reads these sets, or their numbers alone
    known = ["n", "h1", "h2"]
    sets = saved(shingle_arrays(source, "id", text, k).withColumns({
        "n": F.size("sh"), "h1": F.xxhash64("sh"), "h2": F.xxhash64(F.lit(7), "sh")}), "sets")
    rows = sets.select("id", *known)
    classes = saved(rows.filter("n > 0 and id is not null").groupBy(*known).agg(F.min("id").alias("class_id")), "classes")
    # one set per class, and per id should texts share one
    rep = classes.groupBy(F.col("class_id").alias("id")).agg(F.min(F.struct(*known)).alias("_set"))
    own = rep.select("id", "_set.n")
    shared = [saved(_shared_grams(sets, rep, known, i), "shared") for i in range(SLICES)]
    shared = functools.reduce(DataFrame.unionAll, shared)
    # shingles of one class come first in every order; only how many there are matters
    held = shared.groupBy("id").agg(F.count(F.lit(1)).alias("_shared")).join(own, "id").select(
        "id", "n", (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("_shared"))).alias("take"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "gram"))
    prefix = shared.join(held.filter("take > 0"), "id").withColumn("_at", place).filter(F.col("_at") <= F.col("take")).select("gram", "id", "n")
    ends = prefix.groupBy("gram").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi")
    buckets = saved(prefix.join(ends, "gram"), "buckets")
    texts = saved(_class_sets(sets, rep.join(buckets.select("id").distinct(), "id", "left_semi"), known), "sets")
    star = buckets.select(F.inline(F.array(F.struct(F.col("lo").alias("a"), F.col("id").alias("c")),
                                           F.struct(F.col("id").alias("a"), F.col("hi").alias("c"))))).filter("a <> c").distinct()
    tried = saved(star, "pairs")
    links = saved(_confirmed(tried, own, texts, percent), "links")
    found = saved(star_components(links), "components")
    # buckets with several components: members of different ones are compared
    b = buckets.select("gram", "id", "n").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = b.groupBy("gram").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo <> _hi").select("gram")
    open_ = saved(b.join(mixed, "gram"), "open")
    x, y = (open_.select("gram", F.col("id").alias(i), F.col("n").alias(f"n{i}"), F.col("component").alias(f"c{i}")) for i in ("a", "c"))
    pairs = x.join(y, "gram").filter((F.col("a") < F.col("c")) & (F.col("ca") != F.col("cc")) & (
        100 * F.least("na", "nc") >= percent * F.greatest("na", "nc"))).select("a", "c").distinct().join(tried, ["a", "c"], "left_anti")
    more = saved(_confirmed(pairs, own, texts, percent), "links")
    if some(more):
        found = saved(star_components(links.unionAll(more)), "components")
    named = classes.join(found, F.col("class_id") == F.col("id"), "left").select(*known, "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return rows.join(named, known, "left").select(F.col("id").alias(key), F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"),
                                                  F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def _class_sets(sets: DataFrame, rep: DataFrame, known: list[str]) -> DataFrame:
    """(id, sh) of each id of ``rep``, whose set it names by its numbers."""
    return sets.join(rep, "id").filter(F.struct(*known) == F.col("_set")).select("id", "sh").dropDuplicates(["id"])


def _shared_grams(sets: DataFrame, rep: DataFrame, known: list[str], part: int) -> DataFrame:
    """(gram, id, df) for the shingles of slice ``part`` that several classes have, from one shuffle by shingle."""
    here = sets.withColumn("sh", F.filter("sh", lambda g: F.pmod(F.shiftright(g, 7), F.lit(SLICES)) == part))
    grams = _class_sets(here, rep, known).select("id", F.explode("sh").alias("gram")).repartition("gram")
    return grams.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("gram"))).filter("df > 1").select("gram", "id", "df")


def _confirmed(pairs: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, c) whose whole sets reach the similarity."""
    p = pairs.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(
        sizes.select(F.col("id").alias("c"), F.col("n").alias("nc")), "c")
    p = p.filter(100 * F.least("na", "nc") >= percent * F.greatest("na", "nc"))
    p = p.join(sets.select(F.col("id").alias("a"), F.col("sh").alias("sa")), "a").join(sets.select(F.col("id").alias("c"), F.col("sh").alias("sc")), "c")
    both = F.size(F.array_intersect("sa", "sc"))
    return p.withColumn("_both", both).filter(100 * F.col("_both") >= percent * (F.col("na") + F.col("nc") - F.col("_both"))).select("a", "c")
