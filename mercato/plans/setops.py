"""Sort / limit / sampling / set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators.relational import seeded_hash
from mercato.plans.registry import register
from mercato.sinks.writers import sample_export
from mercato.sources.tables import Tables, tracking


@register("top_products_by_value", "G1", sql="""
SELECT product_id, round(SUM(price_numeric), 2) AS value, COUNT(*) AS n FROM tracking GROUP BY product_id
ORDER BY value DESC, product_id LIMIT 30""")
def top_products_by_value(spark, sf):
    """Top-k report: the limit is the feature (TakeOrdered over per-product totals)."""
    tr = tracking(Tables(spark, sf))
    g = tr.groupBy("product_id").agg(F.round(F.sum("price_numeric"), 2).alias("value"),
                                     F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("value"), "product_id").limit(30)


@register("ordered_limit_sample", "G2", sql="""
SELECT product_id, date, order_id, package_size_id, price_numeric FROM tracking
ORDER BY date DESC, order_id, package_size_id LIMIT 1000""")
def ordered_limit_sample(spark, sf):
    """``LIMIT n`` made deterministic by an explicit order (the limit is the feature)."""
    tr = tracking(Tables(spark, sf)).select("product_id", "date", "order_id", "package_size_id", "price_numeric")
    return tr.orderBy(F.desc("date"), "order_id", "package_size_id").limit(1000)


@register("hash_train_test_split", "G5", sql="""
SELECT CASE WHEN ('0x' || substr(md5(order_id || ':' || package_size_id || ':7'), 1, 12))::BIGINT % 100 < 80
            THEN 'train' ELSE 'test' END AS split, catalog_id, COUNT(*) AS n
FROM tracking GROUP BY ALL""")
def hash_train_test_split(spark, sf):
    """Stable 80/20 split by a seeded key hash; counts per split and catalogue."""
    tr = tracking(Tables(spark, sf))
    bucket = seeded_hash("order_id", "package_size_id", seed=7) % 100
    split = F.when(bucket < 80, "train").otherwise("test")
    return tr.groupBy(split.alias("split"), "catalog_id").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_split", "G5", sql="""
WITH r AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS place,
                  COUNT(*) OVER (PARTITION BY label) AS k FROM embeddings)
SELECT label, CASE WHEN place < 0.75 * k THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n FROM r GROUP BY ALL""")
def stratified_split(spark, sf):
    """Per-class 75/25 split by hash rank within class (class proportions kept
    exactly; ranks computed per hash range, see ``hash_rank_within``)."""
    from mercato.operators.clean import hash_rank_within
    e = Tables(spark, sf).embeddings.select("vec_id", "label")
    r = hash_rank_within(e, "label", "vec_id", seed=3)
    train = (F.col("hash_rank") - 1) < 0.75 * F.col("group_size")
    return (r.withColumn("split", F.when(train, "train").otherwise("test"))
            .groupBy("label", "split").agg(F.count(F.lit(1)).alias("n")))


@register("union_by_name", "G6", sql="""
SELECT product_id, order_id, package_size_id, price_numeric, NULL AS view_count, 'returned' AS source
FROM tracking WHERE status = 'R'
UNION ALL
SELECT product_id, order_id, package_size_id, NULL, view_count, 'kept' FROM tracking WHERE status IS DISTINCT FROM 'R'""")
def union_by_name(spark, sf):
    tr = tracking(Tables(spark, sf))
    a = tr.filter(F.col("status") == "R").select("product_id", "order_id", "package_size_id", "price_numeric",
                                                 F.lit("returned").alias("source"))
    b = tr.filter(~F.col("status").eqNullSafe("R")).select("product_id", "order_id", "package_size_id", "view_count",
                                                 F.lit("kept").alias("source"))
    return a.unionByName(b, allowMissingColumns=True).select(
        "product_id", "order_id", "package_size_id", "price_numeric", "view_count", "source")


@register("distinct_pairs", "G7", sql="""SELECT DISTINCT product_id, catalog_id FROM tracking""")
def distinct_pairs(spark, sf):
    return tracking(Tables(spark, sf)).select("product_id", "catalog_id").distinct()


@register("exact_n_sample", "G10", sql="""
SELECT doc_id, lang FROM documents
ORDER BY ('0x' || substr(md5(doc_id || ':11'), 1, 12))::BIGINT, doc_id LIMIT 100""")
def exact_n_sample(spark, sf):
    """Exactly n rows without replacement: smallest seeded hashes (a sampling operator)."""
    d = Tables(spark, sf).documents.select("doc_id", "lang")
    return d.orderBy(seeded_hash("doc_id", seed=11), "doc_id").limit(100)


@register("fraction_sample_export", "B4", sql="""
SELECT * FROM tracking WHERE ('0x' || substr(md5(order_id || ':42'), 1, 12))::BIGINT % 1000000 < 10000""")
def fraction_sample_export(spark, sf):
    """1 % deterministic sample of the snapshot table (hash-bucket filter)."""
    return sample_export(tracking(Tables(spark, sf)), 0.01, "order_id")
