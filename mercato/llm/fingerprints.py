"""Document fingerprints: threshold-scaled sketches of shingle hashes (DataFrame functions only).

A sketch keeps every distinct hash of a run of ``shingle`` words (a shorter text: its whole word
sequence) that lies in the lowest ``1/scale`` of the hash range.  The threshold is fixed, so the sketch
of a union is the union of sketches (``merge``), and containment can be estimated between documents of
very unequal length.  The fingerprint string is the digest of the whole text and the kept hashes: equal
texts have equal fingerprints, and texts too short to keep a hash are still told apart.

Likeness is the Jaccard estimate |A and B| / |A or B| of two sketches, 1 for equal texts, and 0 where both
sketches are empty.  Null texts count as empty.  Words are as in the other operators; case matters not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import cuts, range_of, shuffle_partitions

SHINGLE = 5
SCALE = 4


def threshold(scale: int) -> int:
    """Largest kept hash: the lowest 1/scale of the signed 64-bit range."""
    return -(1 << 63) + (1 << 64) // scale - 1


def with_sketch(df: DataFrame, text: str, to: str, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Adds ``to``: the sorted kept hashes of ``text`` (array of long)."""
    w, h = f"{to}_w", f"{to}_h"
    df = df.withColumn(w, F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+", -1),
                                   lambda x: x != ""))
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - shingle),
                       lambda i: F.xxhash64(*[F.get(F.col(w), i + j) for j in range(shingle)]))
    whole = F.filter(F.array(F.xxhash64(F.col(w))), lambda x: F.size(w) > 0)
    df = df.withColumn(h, F.when(F.size(w) >= shingle, runs).otherwise(whole))
    return df.withColumn(to, F.array_sort(F.array_distinct(
        F.filter(F.col(h), lambda x: x <= F.lit(threshold(scale)))))).drop(w, h)


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either > 0, both / either).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too; 0 for an empty sketch."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(0.0))


def merge(df: DataFrame, by: str, sketch: str, to: str = "sketch") -> DataFrame:
    """Sketch of all documents of each group: distinct kept hashes, combined before the shuffle."""
    # outer: else Spark would test the sketch's size below the columns that compute it
    return (df.select(by, F.explode_outer(sketch).alias("_f_h")).filter("_f_h is not null").distinct()
            .groupBy(by).agg(F.array_sort(F.collect_list("_f_h")).alias(to)))


def written(text_digest: Column, sketch: Column) -> Column:
    """The fingerprint as a string: whole-text digest, then the kept hashes in hexadecimal."""
    return F.concat(text_digest, F.lit(":"), F.array_join(F.transform(sketch, lambda x: F.lower(F.hex(x))), ","))


def fingerprint(docs: DataFrame, text: str = "text", to: str = "fingerprint", shingle: int = SHINGLE,
                scale: int = SCALE) -> DataFrame:
    """``docs`` with its fingerprint string and, as ``_sketch``, the kept hashes."""
    df = with_sketch(docs, text, "_sketch", shingle, scale)
    return df.withColumn(to, written(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), F.col("_sketch")))


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, next text) where next is the following row by descending key (nulls last; rows of one key
    by text), and the first row follows the last.

    Keys are dealt into ranges; a range is sorted in one task.  Each range's first row is also given to the
    range before it (the first range's to the last), so texts are shuffled once.  Only the largest key of
    each range reaches the driver."""
    points = cuts(docs, key, 4 * shuffle_partitions(docs.sparkSession))
    d = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.withColumn("r", range_of(F.col("k"), points))
    order = [F.col("k").desc_nulls_last(), F.col("t")]
    # first row of a range: largest key; among its rows the smallest text, needed only where the key repeats
    top = d.groupBy("r").agg(F.max("k").alias("k")).collect()
    ranges = sorted((x["r"] for x in top), reverse=True)
    before = dict(zip(ranges, ranges[-1:] + ranges[:-1]))
    firsts = {x["r"]: x["k"] for x in top}
    if not ranges:
        return d.withColumn("n", F.lit("")).select("k", "t", "n")
    keys = [F.lit(k).cast("long") for k in firsts.values() if k is not None]
    is_first = F.col("k").isin(*keys) if keys else F.lit(False)
    if any(k is None for k in firsts.values()):
        is_first = is_first | F.col("k").isNull()
    to = F.element_at(F.create_map(*[F.lit(x) for p in before.items() for x in p]), F.col("r"))
    guests = (d.filter(F.coalesce(is_first, F.lit(False))).groupBy("r", "k").agg(F.min("t").alias("t"))
              .select("k", "t", to.alias("r"), F.lit(1).alias("guest")))
    both = d.select("k", "t", "r", F.lit(0).alias("guest")).unionByName(guests)
    following = F.lead("t").over(Window.partitionBy("r").orderBy("guest", *order))
    return both.withColumn("n", following).filter("guest = 0").select("k", "t", "n")


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last floor(n/2) code points are those the next
    document begins with; likeness to the edited text and to the next document."""
    d = with_next(docs, key, text).withColumn("n_chars", F.length("t").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("e", F.concat(F.substring("t", F.lit(1), F.length("t") - half), F.substring("n", F.lit(1), half)))
    for c in ("t", "e", "n"):
        d = with_sketch(d, c, f"s_{c}", shingle, scale)
    same = lambda c: F.col("t") == F.col(c)
    d = d.withColumn("sha_e", F.sha2("e", 256))
    return d.select(
        F.col("k").alias("doc_id"), "n_chars", F.col("sha_e").alias("edited_sha256"),
        written(F.sha2("t", 256), F.col("s_t")).alias("fingerprint"),
        written(F.col("sha_e"), F.col("s_e")).alias("edited_fingerprint"),
        F.when(same("e"), F.lit(1.0)).otherwise(likeness(F.col("s_t"), F.col("s_e"))).alias("near_edited"),
        F.when(same("n"), F.lit(1.0)).otherwise(likeness(F.col("s_t"), F.col("s_n"))).alias("near_next"))
