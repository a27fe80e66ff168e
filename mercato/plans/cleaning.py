"""Projection, filters, null handling, casts, label maps and
outlier trims (§2.J J1-J5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators.clean import (
    dense_label_map, median_impute, null_profile, quantile_trim,
    safe_downcast_types, two_stage_trim, zscore_counts,
)
from mercato.operators.relational import frequent_combinations
from mercato.plans.registry import register
from mercato.sources.tables import Tables, tracking


def gappy_tracking(spark, sf):
    """``tracking`` with holes: the driver tables have no NULLs, so a few values
    are blanked by rule to give the null operators work."""
    tr = tracking(Tables(spark, sf))
    return tr.select(
        "product_id", "order_id", "package_size_id", "date", "catalog_id", "view_count", "discount",
        F.nullif(F.col("brand_title"), F.lit("Brand#13")).alias("brand_title"),
        F.when(F.col("size_title") == "7", F.lit("")).otherwise(F.col("size_title")).alias("size_title"),
        F.nullif(F.col("status"), F.lit("R")).alias("status"),
        F.when(F.col("discount") == 0, F.lit(None).cast("double")).otherwise(F.col("price_numeric"))
        .alias("price_numeric"))


GAPPY_SQL = """gappy AS (
  SELECT product_id, order_id, package_size_id, date, catalog_id, view_count, discount,
         NULLIF(brand_title, 'Brand#13') AS brand_title,
         CASE WHEN size_title = '7' THEN '' ELSE size_title END AS size_title,
         NULLIF(status, 'R') AS status,
         CASE WHEN discount = 0 THEN NULL ELSE price_numeric END AS price_numeric
  FROM tracking)"""


@register("projection_rename", "C1", sql="""
SELECT product_id, date, price_numeric AS price, brand_title AS brand FROM tracking""")
def projection_rename(spark, sf):
    tr = tracking(Tables(spark, sf))
    return (tr.select("product_id", "date", "price_numeric", "brand_title", "status")
            .drop("status").withColumnRenamed("price_numeric", "price")
            .withColumnRenamed("brand_title", "brand"))


@register("trailing_interval_filter", "C2", sql="""
SELECT product_id, order_id, date, price_numeric FROM tracking
WHERE date >= (SELECT MAX(date) FROM tracking) - INTERVAL 30 DAY""")
def trailing_interval_filter(spark, sf):
    """The cutoff is a constant by the time the rows are read, so the scan skips older ones by their statistics."""
    t = Tables(spark, sf)
    last = tracking(t).agg(F.max("date")).first()[0]
    if last is None:
        return tracking(t).select("product_id", "order_id", "date", "price_numeric")
    return tracking(t, since=last - dt.timedelta(days=30)).select("product_id", "order_id", "date", "price_numeric")


@register("half_open_pull_window", "C3", sql="""
WITH b AS (SELECT date_trunc('hour', MAX(ts)) AS hi FROM events)
SELECT event_id, ts, user_id, event_type FROM events, b
WHERE ts >= b.hi - INTERVAL 1 HOUR AND ts < b.hi""")
def half_open_pull_window(spark, sf):
    e = Tables(spark, sf).events
    hi = e.select(F.date_trunc("hour", F.max("ts"))).scalar()
    return (e.filter((F.col("ts") >= hi - F.expr("INTERVAL 1 HOUR")) & (F.col("ts") < hi))
            .select("event_id", "ts", "user_id", "event_type"))


@register("quantile_range_filter", "C4", sql="""
WITH q AS (SELECT quantile_cont(price_numeric, 0.05) AS lo, quantile_cont(price_numeric, 0.95) AS hi FROM tracking)
SELECT product_id, order_id, price_numeric FROM tracking, q
WHERE price_numeric > q.lo AND price_numeric < q.hi""")
def quantile_range_filter(spark, sf):
    tr = tracking(Tables(spark, sf))
    return quantile_trim(tr, "price_numeric", 0.05, 0.95, inclusive=False).select(
        "product_id", "order_id", "price_numeric")


@register("frequent_label_filter", "C5", sql="""
WITH s1 AS (SELECT * FROM tracking WHERE size_title IN
              (SELECT size_title FROM tracking GROUP BY size_title HAVING COUNT(*) > 1200)),
s2 AS (SELECT * FROM s1 WHERE brand_title IN (SELECT brand_title FROM s1 GROUP BY brand_title HAVING COUNT(*) > 1200)),
s3 AS (SELECT * FROM s2 WHERE catalog_id IN (SELECT catalog_id FROM s2 GROUP BY catalog_id HAVING COUNT(*) > 1200))
SELECT catalog_id, brand_title, size_title, COUNT(*) AS n FROM s3 GROUP BY ALL""")
def frequent_label_filter(spark, sf):
    tr = tracking(Tables(spark, sf))
    return frequent_combinations(tr, ["size_title", "brand_title", "catalog_id"], 1200).select(
        "catalog_id", "brand_title", "size_title", "n")


@register("equality_filter", "C6", sql="""
SELECT product_id, order_id, price_numeric FROM tracking WHERE status = 'R' AND catalog_id = 'PROMO'""")
def equality_filter(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.filter((F.col("status") == "R") & (F.col("catalog_id") == "PROMO")).select(
        "product_id", "order_id", "price_numeric")


@register("null_profile", "C7", sql="WITH " + GAPPY_SQL + """
SELECT """ + ",\n".join(f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in
                       ["brand_title", "size_title", "status", "price_numeric", "catalog_id"]) + " FROM gappy")
def null_profile_q(spark, sf):
    return null_profile(gappy_tracking(spark, sf),
                        ["brand_title", "size_title", "status", "price_numeric", "catalog_id"])


@register("dropna_any", "C8", sql="WITH " + GAPPY_SQL + """
SELECT product_id, order_id, package_size_id FROM gappy
WHERE brand_title IS NOT NULL AND size_title IS NOT NULL AND status IS NOT NULL AND price_numeric IS NOT NULL
  AND NOT isnan(price_numeric)""")
def dropna_any(spark, sf):
    g = gappy_tracking(spark, sf).select("product_id", "order_id", "package_size_id", "brand_title",
                                         "size_title", "status", "price_numeric")
    return g.na.drop("any").select("product_id", "order_id", "package_size_id")


@register("fill_constants", "C9", sql="WITH " + GAPPY_SQL + """
SELECT COALESCE(brand_title, 'no_brand') AS brand_title,
       CASE WHEN size_title = '' THEN 'no_size' ELSE size_title END AS size_title,
       COALESCE(status, 'no_status') AS status, COUNT(*) AS n
FROM gappy GROUP BY ALL""")
def fill_constants(spark, sf):
    g = gappy_tracking(spark, sf)
    filled = (g.na.replace("", "no_size", subset=["size_title"])
              .na.fill({"brand_title": "no_brand", "status": "no_status"}))
    return filled.groupBy("brand_title", "size_title", "status").agg(F.count(F.lit(1)).alias("n"))


@register("median_impute", "C10", sql="WITH " + GAPPY_SQL + """,
med AS (SELECT catalog_id, quantile_cont(price_numeric, 0.5) AS m FROM gappy GROUP BY catalog_id)
SELECT g.product_id, g.order_id, g.package_size_id, COALESCE(g.price_numeric, med.m) AS price_numeric
FROM gappy g JOIN med ON g.catalog_id = med.catalog_id""")
def median_impute_q(spark, sf):
    g = gappy_tracking(spark, sf)
    return median_impute(g, "price_numeric", ["catalog_id"]).select(
        "product_id", "order_id", "package_size_id", "price_numeric")


@register("conditional_column", "C11", sql="""
SELECT product_id, order_id, package_size_id,
       CASE WHEN price_numeric >= 50000 THEN 'high' WHEN price_numeric >= 10000 THEN 'mid' ELSE 'low' END AS band,
       CASE WHEN view_count > 25 THEN 'Yes' ELSE 'No' END AS bulk
FROM tracking""")
def conditional_column(spark, sf):
    tr = tracking(Tables(spark, sf))
    band = (F.when(F.col("price_numeric") >= 50000, "high").when(F.col("price_numeric") >= 10000, "mid")
            .otherwise("low"))
    return tr.select("product_id", "order_id", "package_size_id", band.alias("band"),
                     F.when(F.col("view_count") > 25, "Yes").otherwise("No").alias("bulk"))


@register("cast_columns", "C12", sql="""
SELECT product_id, order_id, package_size_id, CAST(trunc(price_numeric) AS INTEGER) AS price_int,
       CAST(view_count AS BIGINT) AS views, CAST(size_title AS INTEGER) AS size_num,
       TRY_CAST(brand_title AS INTEGER) AS brand_num
FROM tracking""")
def cast_columns(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.select("product_id", "order_id", "package_size_id",
                     F.col("price_numeric").cast("int").alias("price_int"),
                     F.col("view_count").cast("bigint").alias("views"),
                     F.col("size_title").cast("int").alias("size_num"),
                     F.col("brand_title").try_cast("int").alias("brand_num"))


@register("safe_downcast", "C13", sql="""
WITH m AS (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS BIGINT) AS min_value, CAST(MAX({c}) AS BIGINT) AS max_value "
    f"FROM lineitem" for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]) + """)
SELECT column_name, min_value, max_value,
  CASE WHEN min_value >= -128 AND max_value <= 127 THEN 'tinyint'
       WHEN min_value >= -32768 AND max_value <= 32767 THEN 'smallint'
       WHEN min_value >= -2147483648 AND max_value <= 2147483647 THEN 'int' ELSE 'bigint' END AS target_type
FROM m""")
def safe_downcast(spark, sf):
    return safe_downcast_types(Tables(spark, sf).lineitem,
                               ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@register("wide_to_long_tagged", "C15", sql="""
WITH s AS (SELECT user_id, CAST(COUNT(*) AS DOUBLE) AS n_rows, SUM(view_count) AS views
           FROM tracking GROUP BY user_id)
SELECT user_id, 'n_rows' AS feature, n_rows AS value, 'tracking' AS source FROM s
UNION ALL SELECT user_id, 'views', views, 'tracking' FROM s""")
def wide_to_long_tagged(spark, sf):
    tr = tracking(Tables(spark, sf))
    s = tr.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n_rows"),
                                  F.sum("view_count").alias("views"))
    return s.unpivot(["user_id"], ["n_rows", "views"], "feature", "value").withColumn(
        "source", F.lit("tracking"))


@register("label_map", "C16", sql="""
WITH m AS (SELECT catalog_id, CAST(dense_rank() OVER (ORDER BY catalog_id) - 1 AS INTEGER) AS label_id
           FROM (SELECT DISTINCT catalog_id FROM tracking))
SELECT t.catalog_id, m.label_id, COUNT(*) AS n FROM tracking t JOIN m ON t.catalog_id = m.catalog_id
GROUP BY t.catalog_id, m.label_id""")
def label_map(spark, sf):
    tr = tracking(Tables(spark, sf))
    m = dense_label_map(tr, "catalog_id", "label_id")
    return tr.join(m, "catalog_id").groupBy("catalog_id", "label_id").agg(F.count(F.lit(1)).alias("n"))


@register("global_quantile_trim", "J1", sql="""
WITH q AS (SELECT quantile_cont(price_numeric, 0.01) AS lo, quantile_cont(price_numeric, 0.99) AS hi FROM tracking)
SELECT catalog_id, COUNT(*) AS n, MIN(price_numeric) AS min_price, MAX(price_numeric) AS max_price
FROM tracking, q WHERE price_numeric >= q.lo AND price_numeric <= q.hi GROUP BY catalog_id""")
def global_quantile_trim(spark, sf):
    tr = tracking(Tables(spark, sf))
    kept = quantile_trim(tr, "price_numeric", 0.01, 0.99, inclusive=True)
    return kept.groupBy("catalog_id").agg(F.count(F.lit(1)).alias("n"),
                                          F.min("price_numeric").alias("min_price"),
                                          F.max("price_numeric").alias("max_price"))


@register("category_quantile_trim", "J2+M2", sql="""
WITH q AS (SELECT catalog_id, quantile_cont(price_numeric, 0.05) AS lo, quantile_cont(price_numeric, 0.9) AS hi
           FROM tracking GROUP BY catalog_id)
SELECT t.product_id, t.order_id, t.package_size_id, t.catalog_id, t.price_numeric
FROM tracking t JOIN q ON t.catalog_id = q.catalog_id
WHERE t.price_numeric >= q.lo AND t.price_numeric <= q.hi""")
def category_quantile_trim(spark, sf):
    tr = tracking(Tables(spark, sf)).select("product_id", "order_id", "package_size_id", "catalog_id",
                                            "price_numeric")
    return quantile_trim(tr, "price_numeric", 0.05, 0.9, by=["catalog_id"], inclusive=True)


@register("two_stage_group_trim", "J3", sql="""
WITH q1 AS (SELECT catalog_id, status, quantile_cont(price_numeric, 0.99) AS p99,
                   quantile_cont(view_count, 0.99) AS v99, quantile_cont(discount, 0.99) AS d99
            FROM tracking GROUP BY catalog_id, status),
s1 AS (SELECT t.* FROM tracking t JOIN q1 ON t.catalog_id = q1.catalog_id AND t.status = q1.status
       WHERE t.price_numeric <= q1.p99 AND t.view_count <= q1.v99 AND t.discount <= q1.d99),
q2 AS (SELECT catalog_id, status, quantile_cont(price_numeric, 0.025) AS p025 FROM s1 GROUP BY catalog_id, status)
SELECT s1.product_id, s1.order_id, s1.package_size_id, s1.catalog_id, s1.status, s1.price_numeric
FROM s1 JOIN q2 ON s1.catalog_id = q2.catalog_id AND s1.status = q2.status
WHERE s1.price_numeric > q2.p025""")
def two_stage_group_trim(spark, sf):
    tr = tracking(Tables(spark, sf)).select("product_id", "order_id", "package_size_id", "catalog_id",
                                            "status", "price_numeric", "view_count", "discount")
    out = two_stage_trim(tr, ["catalog_id", "status"], ["price_numeric", "view_count", "discount"],
                         0.99, "price_numeric", 0.025)
    return out.select("product_id", "order_id", "package_size_id", "catalog_id", "status", "price_numeric")


@register("zscore_mad_iqr_rules", "J4", sql="""
WITH s AS (SELECT catalog_id, AVG(price_numeric) AS mu, stddev_samp(price_numeric) AS sd,
                  quantile_cont(price_numeric, 0.5) AS med, quantile_cont(price_numeric, 0.25) AS q1,
                  quantile_cont(price_numeric, 0.75) AS q3 FROM tracking GROUP BY catalog_id),
d AS (SELECT t.catalog_id, t.price_numeric, s.mu, s.sd, s.med, s.q1, s.q3,
             abs(t.price_numeric - s.med) AS dev FROM tracking t JOIN s ON t.catalog_id = s.catalog_id),
m AS (SELECT catalog_id, quantile_cont(dev, 0.5) AS mad FROM d GROUP BY catalog_id)
SELECT d.catalog_id, COUNT(*) AS n,
       COUNT(*) FILTER (WHERE abs((price_numeric - mu) / sd) < 3) AS n_z_kept,
       COUNT(*) FILTER (WHERE abs(0.6745 * (price_numeric - med) / m.mad) <= 3.5) AS n_mad_kept,
       COUNT(*) FILTER (WHERE price_numeric >= q1 - 1.5 * (q3 - q1) AND price_numeric <= q3 + 1.5 * (q3 - q1))
         AS n_iqr_kept
FROM d JOIN m ON d.catalog_id = m.catalog_id GROUP BY d.catalog_id""")
def zscore_mad_iqr_rules(spark, sf):
    tr = tracking(Tables(spark, sf))
    return zscore_counts(tr, "price_numeric", ["catalog_id"])


@register("density_novelty_filter", "J5", sql="""
WITH b AS (SELECT MIN(price_numeric) AS lo, MAX(price_numeric) AS hi, COUNT(*) AS n FROM tracking),
x AS (SELECT LEAST(CAST(floor((price_numeric - lo) / (hi - lo) * 50) AS INTEGER) + 1, 50) AS bin, n
      FROM tracking, b),
c AS (SELECT bin, COUNT(*) AS cnt, MAX(n) AS n FROM x GROUP BY bin),
r AS (SELECT bin, cnt, n, COALESCE(SUM(cnt) OVER (ORDER BY cnt DESC, bin ROWS BETWEEN UNBOUNDED PRECEDING
                                                AND 1 PRECEDING), 0) AS before FROM c)
SELECT bin, cnt, CASE WHEN before < 0.9 * n THEN 1 ELSE 0 END AS kept FROM r""")
def density_novelty_filter(spark, sf):
    from mercato.operators.clean import density_keep_bins
    return density_keep_bins(tracking(Tables(spark, sf)), "price_numeric", 50, 0.1)


@register("novelty_kept_rows", "J5", sql="""
WITH b AS (SELECT MIN(price_numeric) AS lo, MAX(price_numeric) AS hi, COUNT(*) AS n FROM tracking),
x AS (SELECT t.product_id, t.order_id, t.package_size_id, t.price_numeric, n,
             LEAST(CAST(floor((price_numeric - lo) / (hi - lo) * 50) AS INTEGER) + 1, 50) AS bin FROM tracking t, b),
c AS (SELECT bin, COUNT(*) AS cnt, MAX(n) AS n FROM x GROUP BY bin),
r AS (SELECT bin, n, COALESCE(SUM(cnt) OVER (ORDER BY cnt DESC, bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT product_id, order_id, package_size_id, price_numeric, bin FROM x WHERE bin IN (SELECT bin FROM r WHERE before < 0.9 * n)""")
def novelty_kept_rows(spark, sf):
    """The rows that the novelty filter keeps."""
    from mercato.operators.clean import density_keep_rows
    tr = tracking(Tables(spark, sf)).select("product_id", "order_id", "package_size_id", "price_numeric")
    return density_keep_rows(tr, "price_numeric", 50, 0.1)


@register("class_undersample_counts", "G4", sql="""
WITH c AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality)
SELECT quality, (SELECT MIN(n) FROM c) AS n_kept FROM c""")
def class_undersample_counts(spark, sf):
    from mercato.operators.clean import undersample
    kept = undersample(Tables(spark, sf).labels, "quality", "doc_id", seed=42)
    return kept.groupBy("quality").agg(F.count(F.lit(1)).alias("n_kept"))


@register("exact_duplicate_documents", "G8", sql="""
SELECT sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS text_hash,
       MIN(doc_id) AS doc_id, COUNT(*) AS n_copies
FROM documents GROUP BY text_hash""")
def exact_duplicate_documents(spark, sf):
    from mercato.operators.textops import exact_dedup
    return exact_dedup(Tables(spark, sf).documents, "doc_id", "text")


@register("group_transform_mean", "M3+F5", sql="""
WITH m AS (SELECT catalog_id, CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n
           FROM tracking GROUP BY ALL)
SELECT catalog_id, month, n,
       round(AVG(n) OVER (PARTITION BY catalog_id ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 4)
         AS rolling_12,
       round(AVG(n) OVER (PARTITION BY catalog_id), 4) AS catalog_mean
FROM m""")
def group_transform_mean(spark, sf):
    tr = tracking(Tables(spark, sf))
    m = tr.groupBy("catalog_id", F.trunc("date", "MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    # Windows run on the monthly series (bounded by the calendar), not on raw rows.
    w = Window.partitionBy("catalog_id")
    return m.select("catalog_id", "month", "n",
                    F.round(F.avg("n").over(w.orderBy("month").rowsBetween(-11, 0)), 4).alias("rolling_12"),
                    F.round(F.avg("n").over(w), 4).alias("catalog_mean"))
