"""Mixing sources to target weights (DataFrame functions only).

Words are summed by source.  Sources in code-point order (null last) weigh ``weights`` in turn and
share all words; no target exceeds ``cap`` times its source's words, and what that leaves over is shared
again by weight until no target is above.  A source's rate is target / words: each of its documents is
taken floor(rate) times and, with probability equal to the fraction, once more.  The draw is a hash of the
document and a seed; among ``seeds`` seeds each source uses the one whose total comes nearest to its
target (smallest seed on ties), so small sources do not stray by chance and reruns agree.

Defined cases: null or empty texts have size 0 and are drawn like others (they take no words); a null
source is a source; a source without words has target 0 and rate 0; repeated rows count separately but,
with the same id, draw alike; null ids draw by their text; an empty table gives an empty result.  Only
the named columns are read; internal columns start with ``_m_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import WORD, saved

WEIGHTS = (5, 2, 1)
CAP = 3
SEEDS = 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1): 48 bits of a digest of the document's id (its text's digest if null) and a seed."""
    who = F.coalesce(key.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), who)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_weights(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Adds ``weight`` to one row per source: ``weights`` in turn along the sources' order.

    The order is taken over ranges of sources, so that no task sees them all: rank in the range plus the
    rows of earlier ranges (one count per range)."""
    n = max(1, int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = saved(sizes.repartitionByRange(n, F.col("_m_source").asc_nulls_last())
                   .withColumn("_m_range", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("_m_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_m_range").agg(F.count(F.lit(1)).alias("_m_n")).withColumn(
        "_m_before", F.coalesce(F.sum("_m_n").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_m_range").orderBy(F.col("_m_source").asc_nulls_last()))
    rank = (F.col("_m_before") + F.col("_m_place") - 1) % len(weights)
    return ranged.withColumn("_m_place", place).join(counts.drop("_m_n"), "_m_range").withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]), rank.cast("int")).cast("long")).select(
        "_m_source", "source_size", "weight")


def targets(weighted: DataFrame, cap: int) -> DataFrame:
    """Adds ``target``: shares of all words by weight, capped, the excess shared again among the others.

    Each round fixes the sources above their cap; two sums reach the driver.  A round without a new one
    ends it, so there are at most as many rounds as distinct caps per weight."""
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    unit, fixed = 0.0, -1
    while True:
        above = (F.col("weight") * F.lit(unit) > cap * F.col("source_size")) if fixed >= 0 else F.lit(False)
        r = weighted.agg(F.sum(F.when(above, cap * F.col("source_size")).otherwise(0)).alias("taken"),
                         F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
                         F.sum(F.when(above, 1).otherwise(0)).alias("n")).first()
        if r["n"] is None or r["n"] == fixed or not r["weight"]:
            break
        fixed, unit = r["n"], (total - r["taken"]) / r["weight"]
    return weighted.withColumn("target", F.least((F.col("weight") * F.lit(float(unit))).cast("double"),
                                                 (cap * F.col("source_size")).cast("double")))


def with_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seeds: int = SEEDS) -> DataFrame:
    """``docs`` with the struct ``_mix``: size, source_size, target, weight, copies, taken.

    Two passes count words (texts are neither shuffled nor stored): sums by source and seed are combined
    before the shuffle, so a source with most rows costs no more; the table of sources joins the second
    pass as a broadcast only if Spark finds it small, else by a shuffle that splits large partitions."""
    sized = docs.withColumn("_m_size", n_words(F.col(text))).withColumn("_m_source", F.col(source))
    slim = saved(sized.select("_m_source", "_m_size", draws(F.col(key), F.col(text), seeds).alias("_m_u")), "mix-sizes")
    plan = _plan(slim, weights, cap, seeds)
    chosen = sized.join(plan, sized["_m_source"].eqNullSafe(plan["_m_s"]), "left")
    fraction, whole = F.col("rate") - F.floor("rate"), F.floor("rate").cast("long")
    copies = whole + (F.get(draws(F.col(key), F.col(text), seeds), F.col("seed")) < fraction).cast("long")
    return chosen.withColumn("_m_copies", copies).withColumn("_mix", F.struct(
        F.col("_m_size").alias("size"), "source_size", "target", "weight", F.col("_m_copies").alias("copies"),
        (F.col("_m_copies") * F.col("_m_size")).alias("taken"))).select(*docs.columns, "_mix")


def draws(key: Column, text: Column, seeds: int) -> Column:
    return F.array(*[draw(key, text, s) for s in range(seeds)])


def _plan(slim: DataFrame, weights: tuple[int, ...], cap: int, seeds: int) -> DataFrame:
    """One row per source: ``_m_s``, source_size, weight, target, rate and the seed to draw with."""
    sizes = slim.groupBy("_m_source").agg(F.sum("_m_size").alias("source_size"))
    goal = targets(saved(source_weights(sizes, weights), "mix-weights"), cap).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    goal = saved(goal.withColumnRenamed("_m_source", "_m_s"), "mix-targets")
    fraction = F.col("rate") - F.floor("rate")
    tried = slim.join(goal, slim["_m_source"].eqNullSafe(goal["_m_s"])).groupBy("_m_s").agg(*[
        F.sum((F.floor("rate").cast("long") + (F.get("_m_u", F.lit(s)) < fraction).cast("long")) * F.col("_m_size")
              ).alias(f"_m_{s}") for s in range(seeds)], F.first("target").alias("_m_t"))
    best = tried.select(F.col("_m_s").alias("_m_b"), F.array_min(F.array(*[F.struct(
        F.abs(F.col(f"_m_{s}") - F.col("_m_t")).alias("d"), F.lit(s).alias("s")) for s in range(seeds)]))["s"].alias("seed"))
    return goal.join(best, goal["_m_s"].eqNullSafe(best["_m_b"])).drop("_m_b")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seeds: int = SEEDS) -> DataFrame:
    """The rows of ``docs`` (its columns unchanged), each as often as the mix takes it."""
    m = with_copies(docs, key, text, source, weights, cap, seeds)
    times = F.when(F.col("_mix.copies") > 0, F.sequence(F.lit(1), F.col("_mix.copies").cast("int")))
    return m.withColumn("_m_copy", F.explode_outer(times)).filter("_m_copy is not null").select(*docs.columns)


def oracle(weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seeds: int = SEEDS) -> str:
    """DuckDB SQL over ``documents`` for doc_id, size, source_size, target, taken."""
    array = "[" + ", ".join(map(str, weights)) + "]"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, text,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size FROM documents),
s AS MATERIALIZED (SELECT source, sum(size)::BIGINT AS source_size,
    {array}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}) + 1]::BIGINT AS weight
  FROM d GROUP BY source),
rounds AS (
  SELECT 0 AS round, -1::BIGINT AS fixed, 0::BIGINT AS was, (SELECT sum(source_size) FROM s) / (SELECT sum(weight) FROM s) AS unit
  UNION ALL
  SELECT round + 1, n, fixed, CASE WHEN weight > 0 THEN (total - taken) / weight ELSE unit END FROM (
    SELECT r.round, r.fixed, r.unit, (SELECT sum(source_size) FROM s) AS total,
      (SELECT coalesce(sum({cap} * source_size), 0) FROM s WHERE weight * r.unit > {cap} * source_size) AS taken,
      (SELECT coalesce(sum(weight), 0) FROM s WHERE NOT weight * r.unit > {cap} * source_size) AS weight,
      (SELECT count(*) FROM s WHERE weight * r.unit > {cap} * source_size) AS n
    FROM rounds r WHERE r.fixed <> r.was OR r.round < 2) WHERE n <> fixed),
unit AS (SELECT arg_max(unit, round) AS unit FROM rounds),
t AS MATERIALIZED (SELECT source, source_size, least(weight * unit, ({cap} * source_size)::DOUBLE) AS target,
    CASE WHEN source_size > 0 THEN least(weight * unit, ({cap} * source_size)::DOUBLE) / source_size ELSE 0 END AS rate
  FROM s, unit),
u AS MATERIALIZED (SELECT d.doc_id, d.size, t.*, seed, floor(rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5(seed || ':' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 12))::BIGINT / {float(1 << 48)}
      < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest(range({seeds})) AS seed)),
b AS (SELECT source, arg_min(seed, (off, seed)) AS seed
  FROM (SELECT source, seed, abs(sum(copies * size) - any_value(target)) AS off FROM u GROUP BY ALL) GROUP BY source)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken
FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source AND u.seed = b.seed"""
