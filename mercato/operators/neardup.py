"""Near-duplicate documents: MinHash signatures, LSH banding, exact check.

Signatures are ``min(xxhash64(shingle, seed))`` aggregates (JVM-side, map-side
combined) over the distinct sets.  Instead of emitting every pair inside an LSH bucket, each member is
linked to the bucket's smallest id (its representative), which is linear in the bucket's size.  Every link is
then verified with the exact Jaccard similarity of the two shingle sets; members that this
leaves without a link are compared with every earlier member of their buckets, so a bucket of many texts that are
not alike costs a number of comparisons that grows with its square (``similarity`` groups them without pairs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ranges import if_small
from mercato.operators.similarity import saved
from mercato.operators.textops import ngrams, words


def shingle_sets(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """Distinct k-word shingles per document as 64-bit fingerprints (joins and
    shuffles move longs, not strings)."""
    from mercato.operators.relational import spread
    src = spread(df.select(key, text))
    return ngrams(src, key, text, k, short=True).select(key, F.xxhash64("gram").alias("gram")).distinct()


def minhash_signatures(sh: DataFrame, key: str, n_hashes: int) -> DataFrame:
    mins = [F.min(F.xxhash64("gram", F.lit(s))).alias(f"h{s}") for s in range(n_hashes)]
    return sh.groupBy(key).agg(*mins, F.count(F.lit(1)).alias("n_sh"))


def shingle_rows(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """(key, sh): the sets of ``shingle_sets`` as one ascending array per document, made in its row.  Only the rows of ids
    that repeat are shuffled, to unite their sets."""
    from mercato.operators.relational import spread
    src = spread(df.select(key, text)).filter(F.col(key).isNotNull())
    x = src.select(key, words(F.col(text)).alias("_w"))
    size = F.size("_w")
    zipped = F.arrays_zip(*[F.slice("_w", i + 1, F.greatest(size - i, F.lit(1))).alias(f"w{i}") for i in range(k)])
    runs = F.slice(zipped, 1, F.greatest(size - k + 1, F.lit(1)))
    grams = F.transform(runs, lambda z: F.xxhash64(F.concat_ws(" ", *[z[f"w{i}"] for i in range(k)])))
    x = x.filter(size > 0).select(key, F.when(size >= k, F.array_sort(F.array_distinct(grams))).otherwise(
        F.array(F.xxhash64(F.array_join("_w", " ")))).alias("sh"))
    twice = if_small(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key))
    many = x.join(twice, key, "left_semi").groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sh")))).alias("sh"))
    return x.join(twice, key, "left_anti").unionByName(many)


def near_duplicates(df: DataFrame, key: str, text: str, shingle: int = 5, bands: int = 16, rows: int = 4,
                    threshold: float = 0.7) -> DataFrame:
    """(key, rep, jaccard).  Documents with equal sets are a class, named by its smallest id: they share all buckets, so one
    of them is compared and its links hold for all.  Sets move only for the classes that a bucket brings together."""
    # written once: every later step reads the sets and signatures, not the texts
    sets = saved(shingle_rows(df, key, text, shingle).select(
        F.col(key).alias("id"), "sh", F.size("sh").alias("n"), F.xxhash64("sh").alias("h1"), F.xxhash64(F.lit(7), "sh").alias("h2")), "shingles")
    classes = sets.groupBy("n", "h1", "h2").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("docs"))
    members = saved(sets.select("id", "n", "h1", "h2").join(classes, ["n", "h1", "h2"]).select("id", "c", "n", "docs"), "members")
    own = members.filter("id = c").select("c", "n", "docs")
    one = sets.select("id", "sh").join(own.select(F.col("c").alias("id")), "id", "left_semi")
    sig = minhash_signatures(one.select("id", F.explode("sh").alias("gram")), "id", bands * rows)
    band_keys = F.array(*[F.struct(F.lit(b).alias("band"),
                                   F.xxhash64(*[F.col(f"h{b * rows + r}") for r in range(rows)]).alias("bucket"))
                          for b in range(bands)])
    bk = saved(sig.select(F.col("id").alias("c"), band_keys.alias("_bands")), "signatures").select("c", F.inline("_bands"))
    rep = bk.groupBy("band", "bucket").agg(F.min("c").alias("rep"))
    cand = saved(bk.join(rep, ["band", "bucket"]).select("c", "rep").distinct(), "candidates")
    found = saved(_alike(cand.filter("c <> rep"), sets, own, threshold), "links")
    first = cand.filter("c = rep").select("c")
    # a class that is not like its buckets' smallest ids is compared with all members of its buckets; the smallest id of a class
    # stands for its other documents where it leads a bucket itself
    rest = own.join(found.select("c").distinct(), "c", "left_anti")
    alone = first.withColumn("leads", F.lit(True))
    rest = rest.join(alone, "c", "left").select("c", ((F.col("docs") > 1) & F.col("leads").isNull()).alias("all"))
    near = bk.join(rest, "c").join(bk.select(F.col("c").alias("rep"), "band", "bucket"), ["band", "bucket"])
    near = near.filter((F.col("rep") < F.col("c")) | (F.col("all") & (F.col("rep") > F.col("c")))).select("c", "rep", "all").distinct()
    near = near.join(cand, ["c", "rep"], "left_anti")
    more = _alike(near.select("c", "rep"), sets, own, threshold).join(rest, "c")
    more = more.unionByName(rest.filter("all").select("c", F.col("c").alias("rep"), F.lit(1.0).alias("jaccard"), "all"))
    docs = members.select(F.col("id").alias(key), "c")
    same = first.join(members.filter("id <> c"), "c").select(F.col("id").alias(key), F.col("c").alias("rep"), F.lit(1.0).alias("jaccard"))
    led = docs.join(found, "c").select(key, "rep", "jaccard")
    every = members.select(F.col("id").alias("other"), F.col("c").alias("rep"))
    rest = docs.join(more, "c").filter(F.col("all") | (F.col(key) == F.col("c"))).join(every, "rep").filter(
        F.col("other") < F.col(key)).select(key, F.col("other").alias("rep"), "jaccard")
    return same.unionByName(led).unionByName(rest)


def _alike(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (c, rep) whose whole sets reach the similarity, with it, rounded.  Pairs whose sizes rule it out go first."""
    p = pairs.join(sizes.select("c", "n"), "c").join(sizes.select(F.col("c").alias("rep"), F.col("n").alias("m")), "rep")
    p = saved(p.filter(F.round(F.least("n", "m") / F.greatest("n", "m"), 6) >= threshold), "pairs")
    ids = p.select(F.col("c").alias("id")).union(p.select(F.col("rep").alias("id"))).distinct()
    held = saved(sets.select("id", "sh").join(ids, "id", "left_semi"), "sets")
    both = p.join(held.select(F.col("id").alias("c"), F.col("sh").alias("_a")), "c").join(
        held.select(F.col("id").alias("rep"), F.col("sh").alias("_b")), "rep").withColumn("_both", F.size(F.array_intersect("_a", "_b")))
    jaccard = F.round(F.col("_both") / (F.col("n") + F.col("m") - F.col("_both")), 6)
    return both.select("c", "rep", jaccard.alias("jaccard")).filter(F.col("jaccard") >= threshold)


def similarities(pairs: DataFrame, sh: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Exact Jaccard similarity of the pairs (key, rep) that have a shingle in common."""
    rep_sh = sh.select(F.col(key).alias("rep"), "gram")
    inter = (pairs.join(sh, key).join(rep_sh, ["rep", "gram"])
             .groupBy(key, "rep").agg(F.count(F.lit(1)).alias("inter")))
    j = inter.join(sizes, key).join(sizes.select(F.col(key).alias("rep"), F.col("n").alias("n_rep")), "rep")
    return j.select(key, "rep", (F.col("inter") / (F.col("n") + F.col("n_rep") - F.col("inter"))).alias("jaccard"))


def exact_links(sh: DataFrame, key: str, percent: int) -> DataFrame:
    """(key, rep, jaccard): for every document with an earlier one of at least ``percent`` % similarity, at least one.

    Each shingle first offers its smallest id.  Who is not linked by that is compared with every earlier document
    that the exact prefix filter leaves: similar sets share one of the rarest n - ceil(n * percent / 100) + 1
    shingles of each, and their sizes are within the same bound."""
    df = sh.groupBy("gram").agg(F.min(key).alias("rep"), F.count(F.lit(1)).alias("df"))
    sizes = sh.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    enough = F.col("jaccard") >= percent / 100
    first = sh.join(df.filter("df > 1"), "gram").filter(F.col("rep") < F.col(key)).select(key, "rep").distinct()
    found = similarities(first, sh, sizes, key).filter(enough)
    rank = F.row_number().over(Window.partitionBy(key).orderBy("df", "gram"))
    n = F.col("n")
    prefix = (sh.join(df.drop("rep"), "gram").withColumn("at", rank).join(sizes, key)
              .filter(F.col("at") <= n - F.ceil(n * percent / 100) + 1).filter("df > 1").select(key, "gram", "n"))
    rest = prefix.join(found.select(key).distinct(), key, "left_anti")
    earlier = prefix.select(F.col(key).alias("rep"), "gram", F.col("n").alias("m"))
    more = rest.join(earlier, "gram").filter((F.col("rep") < F.col(key)) & (
        100 * F.least("n", "m") >= percent * F.greatest("n", "m"))).select(key, "rep").distinct()
    more = more.join(first, [key, "rep"], "left_anti")
    return found.unionByName(similarities(more, sh, sizes, key).filter(enough))
