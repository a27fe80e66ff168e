"""Joins and the flagship seller-feature query."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators.relational import latest_with_ties, money_avg, reconcile
from mercato.operators.ranges import if_small, join_groups, quantiles
from mercato.plans.registry import register
from mercato.sources.tables import Tables, demand, tracking


@register("seller_features_latest", "D3+E1", sql="""
WITH newest AS (SELECT * FROM tracking QUALIFY rank() OVER (PARTITION BY product_id ORDER BY date DESC) = 1),
sums AS (SELECT user_id, COUNT(DISTINCT product_id) AS products, COUNT(*) AS k, COUNT(price_numeric) AS priced,
                round(SUM(price_numeric), 2) AS price, SUM(package_size_id) AS sizes, SUM(view_count) AS views,
                SUM(favourite_count) AS favourites FROM newest GROUP BY ALL)
SELECT user_id, products AS count_products, price AS sum_price, price / priced AS avg_price,
       round(views, 2) AS total_views, CAST(favourites AS BIGINT) AS total_favourite,
       round(sizes / k, 4) AS avg_package_size, round(views / k, 4) AS avg_views, round(favourites / k, 4) AS avg_favourite
FROM sums""")
def seller_features_latest(spark, sf):
    """One scan: rows are first reduced to (product, date, seller) partial sums
    (map-side combined); each product's latest date is then picked with a
    window over those pre-aggregated rows: per product, at most its snapshot
    days times its sellers, however many raw rows it has.  Ties on the latest
    date are kept."""
    from pyspark.sql import Window
    tr = tracking(Tables(spark, sf))
    pre = tr.groupBy("product_id", "date", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price_numeric").alias("s_price"),
        F.count("price_numeric").alias("n_price"), F.sum("package_size_id").alias("s_pkg"),
        F.sum("view_count").alias("s_views"), F.sum("favourite_count").alias("s_fav"))
    latest = pre.withColumn("_latest", F.max("date").over(Window.partitionBy("product_id")))
    latest = latest.filter(F.col("date") == F.col("_latest"))
    return latest.groupBy("user_id").agg(
        F.countDistinct("product_id").alias("count_products"),
        F.round(F.sum("s_price"), 2).alias("sum_price"),
        (F.round(F.sum("s_price"), 2) / F.sum("n_price")).alias("avg_price"),
        F.round(F.sum("s_pkg") / F.sum("n"), 4).alias("avg_package_size"),
        F.round(F.sum("s_views"), 2).alias("total_views"),
        F.round(F.sum("s_views") / F.sum("n"), 4).alias("avg_views"),
        F.sum("s_fav").cast("bigint").alias("total_favourite"),
        F.round(F.sum("s_fav") / F.sum("n"), 4).alias("avg_favourite"))


@register("latest_snapshot_rows", "D3", sql="""
SELECT product_id, date, order_id, package_size_id, price_numeric FROM tracking
QUALIFY rank() OVER (PARTITION BY product_id ORDER BY date DESC) = 1""")
def latest_snapshot_rows(spark, sf):
    tr = tracking(Tables(spark, sf)).select("product_id", "date", "order_id", "package_size_id",
                                            "price_numeric")
    return latest_with_ties(tr, "product_id", "date")


@register("lines_left_orders", "D1", sql="""
WITH lines AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id,
         l.l_extendedprice * (1 - l.l_discount) AS ettdeb, o.o_orderdate AS dataobra
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT order_id, line_no, product_id, round(ettdeb, 4) AS ettdeb, dataobra FROM lines""")
def lines_left_orders(spark, sf):
    t = Tables(spark, sf)
    li, o = t.lineitem, t.orders
    return (li.join(o, li.l_orderkey == o.o_orderkey, "left")
            .select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("product_id"),
                    F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("ettdeb"),
                    F.col("o_orderdate").alias("dataobra")))


@register("demand_star_join", "D2", sql="""
SELECT order_id, line_no, product_id, family_id, nome_top_parent, tipo, date,
       round(ettdeb, 4) AS ettdeb, qtt FROM demand""")
def demand_star_join(spark, sf):
    d = demand(Tables(spark, sf))
    return d.select("order_id", "line_no", "product_id", "family_id", "nome_top_parent", "tipo", "date",
                    F.round("ettdeb", 4).alias("ettdeb"), "qtt")


@register("family_hierarchy_join", "D4", sql="""
WITH daily AS (
  SELECT product_id, date, SUM(qtt) AS qtt FROM demand GROUP BY product_id, date),
hierarchy AS (SELECT p_partkey AS product_id, p_type AS family_id, p_brand AS top_parent FROM part)
SELECT d.product_id, d.date, h.family_id, h.top_parent, d.qtt
FROM daily d JOIN hierarchy h ON d.product_id = h.product_id""")
def family_hierarchy_join(spark, sf):
    t = Tables(spark, sf)
    daily = demand(t).groupBy("product_id", "date").agg(F.sum("qtt").alias("qtt"))
    hierarchy = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("family_id"),
                              F.col("p_brand").alias("top_parent"))
    return daily.join(hierarchy, "product_id", "inner").select(
        "product_id", "date", "family_id", "top_parent", "qtt")


@register("brand_semi_join", "D5+E2", sql="""
SELECT brand_title, COUNT(*) AS n_rows, round(SUM(price_numeric), 2) AS sum_price
FROM tracking
WHERE brand_title IN (
  SELECT brand_title FROM tracking
  WHERE date >= (SELECT MAX(date) FROM tracking) - INTERVAL 90 DAY
  GROUP BY brand_title HAVING COUNT(DISTINCT product_id) > 20)
GROUP BY brand_title""")
def brand_semi_join(spark, sf):
    tr = tracking(Tables(spark, sf))
    recent = tr.filter(F.col("date") >= F.date_sub(tr.select(F.max("date")).scalar(), 90))
    brands = (recent.groupBy("brand_title").agg(F.countDistinct("product_id").alias("n"))
              .filter(F.col("n") > 20).select("brand_title"))
    # few brands are broadcast after a count, so the rows are not dealt by a key of few values
    return (tr.join(if_small(brands), "brand_title", "left_semi").groupBy("brand_title")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("price_numeric"), 2).alias("sum_price")))


@register("calendar_spine_fill", "D6", sql="""
WITH daily AS (SELECT family_id, date, SUM(qtt) AS qtt FROM demand GROUP BY family_id, date),
bounds AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM daily),
spine AS (SELECT f.family_id, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS date
          FROM (SELECT DISTINCT family_id FROM daily) f, bounds b)
SELECT s.family_id, s.date, COALESCE(d.qtt, 0.0) AS qtt
FROM spine s LEFT JOIN daily d ON s.family_id = d.family_id AND s.date = d.date""")
def calendar_spine_fill(spark, sf):
    daily = demand(Tables(spark, sf)).groupBy("family_id", "date").agg(F.sum("qtt").alias("qtt"))
    return reconcile(daily, ["family_id"], "date", ["qtt"], fill=0.0)


@register("labels_full_outer", "D7", sql="""
SELECT COALESCE(l.doc_id, d.doc_id) AS doc_id, l.quality, l.toxic, d.n_chars
FROM labels l FULL OUTER JOIN (SELECT doc_id, n_chars FROM documents) d ON l.doc_id = d.doc_id""")
def labels_full_outer(spark, sf):
    t = Tables(spark, sf)
    return (t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id", "full_outer")
            .select("doc_id", "quality", "toxic", "n_chars"))


@register("category_threshold_join", "D8+E19", sql="""
WITH q AS (
  SELECT catalog_id, quantile_cont(price_numeric, 0.05) AS q05, quantile_cont(price_numeric, 0.9) AS q90
  FROM tracking GROUP BY catalog_id)
SELECT t.catalog_id, round(q.q05, 4) AS q05, round(q.q90, 4) AS q90,
       COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN t.price_numeric BETWEEN q.q05 AND q.q90 THEN 1 ELSE 0 END) AS BIGINT) AS n_in_range
FROM tracking t JOIN q ON t.catalog_id = q.catalog_id
GROUP BY t.catalog_id, q.q05, q.q90""")
def category_threshold_join(spark, sf):
    tr = tracking(Tables(spark, sf))
    q = quantiles(tr, "price_numeric", [0.05, 0.9], ["catalog_id"]).select(
        "catalog_id", F.get("_q", F.lit(0)).alias("q05"), F.get("_q", F.lit(1)).alias("q90"))
    inr = F.col("price_numeric").between(F.col("q05"), F.col("q90"))
    return (join_groups(tr, q, ["catalog_id"], "inner").groupBy("catalog_id", "q05", "q90")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(inr).alias("n_in_range"))
            .select("catalog_id", F.round("q05", 4).alias("q05"), F.round("q90", 4).alias("q90"),
                    "n_rows", "n_in_range"))


@register("customer_chain_by_nation", "D10", sql="""
SELECT c.c_nationkey AS nation_id,
       COUNT(DISTINCT c.c_custkey) AS n_customers,
       COUNT(DISTINCT o.o_orderkey) AS n_orders,
       COUNT(DISTINCT l.l_partkey) AS n_parts,
       COUNT(DISTINCT p.p_brand) AS n_brands
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY c.c_nationkey""")
def customer_chain_by_nation(spark, sf):
    t = Tables(spark, sf)
    c, o, li, p = t.customer, t.orders, t.lineitem, t.part
    chain = (c.join(o, o.o_custkey == c.c_custkey).join(li, li.l_orderkey == o.o_orderkey)
             .join(p, p.p_partkey == li.l_partkey))
    return chain.groupBy(F.col("c_nationkey").alias("nation_id")).agg(
        F.countDistinct("c_custkey").alias("n_customers"),
        F.countDistinct("o_orderkey").alias("n_orders"),
        F.countDistinct("l_partkey").alias("n_parts"),
        F.countDistinct("p_brand").alias("n_brands"))
