"""Star schema, upsert image, quality report and serving mart."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mercato.operators.ranges import join_groups, quantiles
from mercato.operators.relational import latest_per_key
from mercato.plans.registry import register
from mercato.session import scratch_path
from mercato.sinks.snapshots import SnapshotTable, surrogate_keys
from mercato.sinks.writers import date_dimension, quality_report
from mercato.sources.tables import Tables, tracking


@register("star_date_dim", "B6", sql="""
WITH b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM tracking),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date FROM b)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date,
       CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week, CAST(day(full_date) AS INTEGER) AS day_of_month,
       CAST(month(full_date) AS INTEGER) AS month, CAST(year(full_date) AS INTEGER) AS year FROM d""")
def star_date_dim(spark, sf):
    return date_dimension(tracking(Tables(spark, sf)).select("date"))


@register("star_users_fact", "B6", sql="""
SELECT user_id, date, COUNT(*) AS item_count, COUNT(*) FILTER (WHERE status = 'R') AS taken_item_count,
       CAST(SUM(favourite_count) AS BIGINT) AS feedback_count
FROM tracking GROUP BY user_id, date""")
def star_users_fact(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("user_id", "date").agg(
        F.count(F.lit(1)).alias("item_count"), F.count_if(F.col("status") == "R").alias("taken_item_count"),
        F.sum("favourite_count").cast("bigint").alias("feedback_count"))


@register("star_city_dim", "B6", sql="""
SELECT CAST(dense_rank() OVER (ORDER BY n.n_name) AS INTEGER) AS city_id, n.n_name AS city,
       n.n_regionkey AS country_id, r.r_name AS country
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def star_city_dim(spark, sf):
    """City and country dimensions from the staging nations (deduplicated)."""
    from mercato.operators.clean import dense_label_map
    t = Tables(spark, sf)
    nation, region = t.nation, t.region
    n = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)  # 5 regions by definition
    ids = dense_label_map(n, "n_name", "city_id")
    ids = ids.withColumn("city_id", (F.col("city_id") + 1).cast("int"))
    return n.join(ids, "n_name").select("city_id", F.col("n_name").alias("city"),
                                        F.col("n_regionkey").alias("country_id"), F.col("r_name").alias("country"))


@register("upsert_merged_image", "B3+L5", sql="""
WITH a AS (SELECT * FROM tracking WHERE date < DATE '2000-01-01'),
b AS (SELECT * FROM tracking WHERE date >= DATE '1999-10-01'),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id, date ORDER BY order_id DESC, package_size_id DESC)
             AS rn FROM u)
SELECT product_id, date, order_id, package_size_id, price_numeric FROM r WHERE rn = 1""")
def upsert_merged_image(spark, sf):
    """Two overlapping loads merged to one row per (product, date): the latest
    wins, and merging the overlap twice changes nothing."""
    tr = tracking(Tables(spark, sf)).select("product_id", "date", "order_id", "package_size_id", "price_numeric")
    a = tr.filter(F.col("date") < F.lit("2000-01-01").cast("date"))
    b = tr.filter(F.col("date") >= F.lit("1999-10-01").cast("date"))
    return latest_per_key(a.unionByName(b), ["product_id", "date"], ["order_id", "package_size_id"])


@register("data_quality_report", "B7", sql="""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (order_id, package_size_id)) AS n_keys,
       COUNT(*) FILTER (WHERE brand_title IS NULL) AS null_brand_title,
       COUNT(*) FILTER (WHERE price_numeric IS NULL) AS null_price_numeric,
       COUNT(*) FILTER (WHERE price_numeric <= 0) AS nonpositive_price_numeric,
       COUNT(*) FILTER (WHERE discount <= 0) AS nonpositive_discount,
       COUNT(*) - COUNT(DISTINCT (order_id, package_size_id)) AS duplicate_keys
FROM tracking""")
def data_quality_report(spark, sf):
    tr = tracking(Tables(spark, sf))
    return quality_report(tr, ["order_id", "package_size_id"], ["brand_title", "price_numeric"],
                          ["price_numeric", "discount"])


@register("serving_mart", "B8", sql="""
SELECT brand_title, CAST(date_trunc('month', date) AS DATE) AS month, COUNT(DISTINCT product_id) AS products,
       COUNT(*) AS snapshots, round(SUM(price_numeric), 2) AS value,
       quantile_cont(price_numeric, 0.5) AS median_price
FROM tracking GROUP BY brand_title, month""")
def serving_mart(spark, sf):
    return _mart(tracking(Tables(spark, sf)))


def _mart(tr):
    tr = tr.withColumn("month", F.trunc("date", "MM"))
    by = ["brand_title", "month"]
    g = tr.groupBy(*by).agg(F.countDistinct("product_id").alias("products"), F.count(F.lit(1)).alias("snapshots"),
                            F.round(F.sum("price_numeric"), 2).alias("value"))
    return join_groups(g, quantiles(tr, "price_numeric", [0.5], by), by).select(
        *g.columns, F.get("_q", F.lit(0)).alias("median_price"))


def _folder(spark, name):
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


@register("serving_mart_table", "B8", sql="""
SELECT brand_title, CAST(date_trunc('month', date) AS DATE) AS month, COUNT(DISTINCT product_id) AS products,
       COUNT(*) AS snapshots, round(SUM(price_numeric), 2) AS value,
       quantile_cont(price_numeric, 0.5) AS median_price
FROM tracking GROUP BY brand_title, month""")
def serving_mart_table(spark, sf):
    """The mart written as a table partitioned by month, and read back."""
    table = SnapshotTable(spark, _folder(spark, "mart"), "month")
    table.replace(_mart(tracking(Tables(spark, sf))))
    return table.read()


@register("upsert_snapshot_table", "B3+L5", sql="""
WITH u AS (SELECT * FROM tracking),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id, user_id ORDER BY date DESC, order_id DESC, package_size_id DESC)
             AS rn FROM u)
SELECT product_id, user_id, date, order_id, package_size_id, price_numeric, status FROM r WHERE rn = 1""")
def upsert_snapshot_table(spark, sf):
    """Two overlapping loads upserted, the second one twice, into a table partitioned by status: keys move between
    partitions, and a replay changes nothing."""
    tr = tracking(Tables(spark, sf)).select("product_id", "user_id", "date", "order_id", "package_size_id", "price_numeric", "status")
    table = SnapshotTable(spark, _folder(spark, "upserts"), "status")
    keys, order = ["product_id", "user_id"], ["date", "order_id", "package_size_id"]
    late = tr.filter(F.col("date") >= F.lit("1999-10-01").cast("date"))
    for load in (tr.filter(F.col("date") < F.lit("2000-01-01").cast("date")), late, late):
        table.upsert(load, keys, order)
    return table.read()


def _staging(spark, sf):
    """Listing rows with the color (first word of the product's name) and the seller's country."""
    t = Tables(spark, sf)
    tr, p, s, n, r = tracking(t), t.part, t.supplier, t.nation, t.region
    places = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("country"))  # 25 nations
    return (tr.join(p.select("p_partkey", F.substring_index("p_name", " ", 1).alias("color")), tr.product_id == F.col("p_partkey"))
            .join(s.select("s_suppkey", "s_nationkey"), tr.user_id == F.col("s_suppkey"), "left")
            .join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select("product_id", "user_id", "date", "order_id", "package_size_id", "price_numeric", "favourite_count", "color", "country"))


STAR_SQL = """
WITH staging AS (SELECT t.*, split_part(p.p_name, ' ', 1) AS color, r.r_name AS country
  FROM tracking t JOIN part p ON t.product_id = p.p_partkey LEFT JOIN supplier s ON t.user_id = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
loads AS (SELECT *, CASE WHEN date < DATE '1997-01-01' THEN 1 ELSE 2 END AS load FROM staging),
color_dim AS (SELECT color, row_number() OVER (ORDER BY load, color) AS color_key
  FROM (SELECT color, MIN(load) AS load FROM loads WHERE color IS NOT NULL GROUP BY color)),
country_dim AS (SELECT country, row_number() OVER (ORDER BY load, country) AS country_key
  FROM (SELECT country, MIN(load) AS load FROM loads WHERE country IS NOT NULL GROUP BY country)),
user_dim AS (SELECT user_id, row_number() OVER (ORDER BY load, user_id) AS user_id_key
  FROM (SELECT user_id, MIN(load) AS load FROM loads WHERE user_id IS NOT NULL GROUP BY user_id))"""


def _star(spark, sf):
    """Two loads, the second one run twice, through the key registries; the staging rows and the dimensions."""
    rows, base = _staging(spark, sf), _folder(spark, "star")
    first = rows.filter(F.col("date") < F.lit("1997-01-01").cast("date"))
    dims = {}
    for load in (first, rows, rows):
        for col in ("color", "country", "user_id"):
            dims[col] = surrogate_keys(load, col, f"{base}/{col}")
    return rows, dims


@register("star_dimensions", "B6", sql=STAR_SQL + """
SELECT 'color' AS dimension, color AS value, color_key AS key FROM color_dim
UNION ALL SELECT 'country', country, country_key FROM country_dim
UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), user_id_key FROM user_dim""")
def star_dimensions(spark, sf):
    """Color, country and users dimensions with stable dense keys, after two loads."""
    _, dims = _star(spark, sf)
    out = None
    for col, dim in dims.items():
        rows = dim.select(F.lit(col).alias("dimension"), F.col(col).cast("string").alias("value"), F.col(f"{col}_key").alias("key"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("star_tracking_fact", "B6", sql=STAR_SQL + """
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id, c.color_key, k.country_key, u.user_id_key, COUNT(*) AS n,
       round(SUM(price_numeric), 2) AS value, CAST(SUM(favourite_count) AS BIGINT) AS favourites
FROM staging s LEFT JOIN color_dim c USING (color) LEFT JOIN country_dim k USING (country) LEFT JOIN user_dim u USING (user_id)
GROUP BY ALL""")
def star_tracking_fact(spark, sf):
    """The tracking fact by keys of its dimensions.  Rows are summed by their values first, so a frequent color or
    country never gathers in one task; the dimensions then join the sums."""
    rows, dims = _star(spark, sf)
    sums = rows.groupBy(F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"), "color", "country", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price_numeric").alias("value"), F.sum("favourite_count").cast("bigint").alias("favourites"))
    for col, dim in dims.items():
        sums = sums.join(dim, col, "left")
    return sums.select("date_id", "color_key", "country_key", "user_id_key", "n", F.round("value", 2).alias("value"), "favourites")
