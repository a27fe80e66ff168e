"""Aggregations: group-bys, HAVING, pivots, rollups, cubes,
describes, histograms, box plots and category rankings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators.ranges import join_groups, quantiles
from mercato.operators.relational import money_avg
from mercato.operators.stats import (
    box_whiskers, describe_categorical, describe_numeric, fixed_bins, skewness_corrected,
)
from mercato.plans.registry import register
from mercato.sources.tables import Tables, demand, tracking

# Catalogue words (a parameter of the text queries that remove or look for them).
CATALOG_VALUES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _recent(tr, days):
    return tr.filter(F.col("date") >= F.date_sub(tr.select(F.max("date")).scalar(), days))


@register("catalog_date_coverage", "E2", sql="""
SELECT catalog_id, COUNT(DISTINCT date) AS n_dates
FROM tracking WHERE date >= (SELECT MAX(date) FROM tracking) - INTERVAL 365 DAY
GROUP BY catalog_id HAVING COUNT(DISTINCT date) > 146""")
def catalog_date_coverage(spark, sf):
    tr = _recent(tracking(Tables(spark, sf)), 365)
    return (tr.groupBy("catalog_id").agg(F.countDistinct("date").alias("n_dates"))
            .filter(F.col("n_dates") > 146))


@register("daily_catalog_median", "E3", sql="""
WITH year AS (SELECT * FROM tracking WHERE date >= (SELECT MAX(date) FROM tracking) - INTERVAL 365 DAY),
days AS (SELECT date, catalog_id, median(price_numeric) AS price, COUNT(product_id) AS k FROM year GROUP BY ALL)
SELECT date, catalog_id, price
FROM (SELECT *, COUNT(*) OVER (PARTITION BY catalog_id) AS n_days FROM days) WHERE n_days > 146 AND k > 2""")
def daily_catalog_median(spark, sf):
    recent = _recent(tracking(Tables(spark, sf)), 365)
    catalogs = (recent.groupBy("catalog_id").agg(F.countDistinct("date").alias("n"))
                .filter(F.col("n") > 146).select("catalog_id"))
    kept = recent.join(catalogs, "catalog_id", "left_semi")
    by = ["date", "catalog_id"]
    n = kept.groupBy(*by).agg(F.count("product_id").alias("n")).filter(F.col("n") > 2)
    return join_groups(n, quantiles(kept, "price_numeric", [0.5], by), by).select(*by, F.get("_q", F.lit(0)).alias("price"))


@register("daily_demand_sums", "E4", sql="""
SELECT product_id, family_id, tipo, date, SUM(qtt) AS qtt, round(SUM(ettdeb), 4) AS ettdeb
FROM demand GROUP BY product_id, family_id, tipo, date""")
def daily_demand_sums(spark, sf):
    return (demand(Tables(spark, sf)).groupBy("product_id", "family_id", "tipo", "date")
            .agg(F.sum("qtt").alias("qtt"), F.round(F.sum("ettdeb"), 4).alias("ettdeb")))


@register("discount_value_monthly", "E5", sql="""
SELECT family_id, CAST(date_trunc('month', date) AS DATE) AS month,
       round(SUM(desconto * ettdeb), 6) AS discount_value, COUNT(*) AS n_lines
FROM demand WHERE desconto <> 0 GROUP BY family_id, month""")
def discount_value_monthly(spark, sf):
    d = demand(Tables(spark, sf)).filter(F.col("desconto") != 0)
    return (d.groupBy("family_id", F.trunc("date", "MM").alias("month"))
            .agg(F.round(F.sum(F.col("desconto") * F.col("ettdeb")), 6).alias("discount_value"),
                 F.count(F.lit(1)).alias("n_lines")))


#: Order lines that one task sums.
ORDER_LINES = 500_000


@register("orders_by_product", "E6", sql="""
SELECT product_id, COUNT(DISTINCT order_id) AS n_orders, SUM(qtt) AS qtt
FROM demand GROUP BY product_id""")
def orders_by_product(spark, sf):
    """Lines are summed per order and product in parts of bounded size first, so that each order counts once; orders, products
    and clients then only say how many rows of ``demand`` a line makes (one, where their keys do not repeat)."""
    t = Tables(spark, sf)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // ORDER_LINES))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").repartition(parts, "l_orderkey")
    lines = lines.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("qtt"))
    clients = t.customer.groupBy(F.col("c_custkey").alias("o_custkey")).agg(F.count(F.lit(1)).alias("_c"))
    orders = t.orders.select("o_orderkey", "o_custkey").join(clients, "o_custkey", "left").groupBy(
        F.col("o_orderkey").alias("l_orderkey")).agg(F.sum(F.coalesce("_c", F.lit(1))).alias("_o"))
    products = t.part.groupBy(F.col("p_partkey").alias("product_id")).agg(F.count(F.lit(1)).alias("_p"))
    sums = lines.join(orders, "l_orderkey", "left").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.count("l_orderkey").alias("n_orders"), F.sum(F.col("qtt") * F.coalesce("_o", F.lit(1))).alias("qtt"))
    return sums.join(products, "product_id", "left").select(
        "product_id", "n_orders", (F.col("qtt") * F.coalesce("_p", F.lit(1))).alias("qtt"))


@register("brand_value_counts", "E7", sql="""
SELECT brand_title, COUNT(*) AS n FROM tracking GROUP BY brand_title ORDER BY n DESC, brand_title""")
def brand_value_counts(spark, sf):
    return (tracking(Tables(spark, sf)).groupBy("brand_title").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "brand_title"))



@register("pivot_count_catalog_size", "E8", sql="""
WITH sizes AS (SELECT DISTINCT size_title FROM tracking WHERE size_title IS NOT NULL),
n AS (SELECT catalog_id, size_title, COUNT(*) AS n FROM tracking GROUP BY ALL),
cells AS (SELECT c.catalog_id, s.size_title, COALESCE(n.n, 0) AS n
          FROM (SELECT DISTINCT catalog_id FROM tracking) c CROSS JOIN sizes s
          LEFT JOIN n ON n.catalog_id IS NOT DISTINCT FROM c.catalog_id AND n.size_title = s.size_title)
SELECT catalog_id, COUNT(*) AS n_columns, array_to_string(list(size_title || '=' || n ORDER BY size_title), ',') AS cells
FROM cells GROUP BY catalog_id""")
def pivot_count_catalog_size(spark, sf):
    """The pivot with one column per size that occurs (Spark reads the domain from the data first), its cells in
    the order of the columns as text, so that a statement with fixed columns can check them all."""
    wide = pivot_count(tracking(Tables(spark, sf)), "catalog_id", "size_title")
    return _cells(wide, "catalog_id", lambda c: F.col(c).cast("string"))


def pivot_count(df, rows, columns):
    """Rows x values of ``columns`` with counts, 0 where there are none."""
    named = df.filter(F.col(columns).isNotNull()).groupBy(rows).pivot(columns).agg(F.count(F.lit(1)))
    return join_groups(df.select(rows).distinct(), named, [rows]).na.fill(0)


def _cells(wide, key, shown):
    names = sorted(c for c in wide.columns if c != key)
    if not names:
        return wide.select(key, F.lit(0).cast("bigint").alias("n_columns"), F.lit("").alias("cells"))
    return wide.select(key, F.lit(len(names)).cast("bigint").alias("n_columns"), F.concat_ws(
        ",", *[F.concat(F.lit(c + "="), F.coalesce(shown(f"`{c}`"), F.lit("-"))) for c in names]).alias("cells"))


_month_cols = ",\n".join(
    f"  COALESCE(SUM(qtt) FILTER (WHERE month(date) = {m}), 0.0) AS m{m:02d}" for m in range(1, 13))


@register("pivot_sum_family_month", "E9", sql=f"""
SELECT family_id,
{_month_cols}
FROM demand GROUP BY family_id""")
def pivot_sum_family_month(spark, sf):
    d = demand(Tables(spark, sf)).withColumn("m", F.month("date"))
    wide = d.groupBy("family_id").pivot("m", list(range(1, 13))).agg(F.sum("qtt"))
    return wide.select("family_id", *[F.coalesce(F.col(str(m)), F.lit(0.0)).alias(f"m{m:02d}")
                                      for m in range(1, 13)])


@register("pivot_median_date_catalog", "E10", sql="""
WITH m AS (SELECT date, catalog_id, quantile_cont(price_numeric, 0.5) AS m FROM tracking GROUP BY date, catalog_id),
cells AS (SELECT d.date, c.catalog_id, m.m FROM (SELECT DISTINCT date FROM tracking) d
          CROSS JOIN (SELECT DISTINCT catalog_id FROM tracking WHERE catalog_id IS NOT NULL) c
          LEFT JOIN m ON m.date = d.date AND m.catalog_id = c.catalog_id)
SELECT date, COUNT(*) AS n_columns,
       array_to_string(list(catalog_id || '=' || COALESCE(CAST(CAST(round(1000 * m) AS BIGINT) AS VARCHAR), '-') ORDER BY catalog_id), ',') AS cells
FROM cells GROUP BY date""")
def pivot_median_date_catalog(spark, sf):
    """Median price of every date and catalogue, one column per catalogue that occurs; cells as text, in thousandths."""
    wide = pivot_median(tracking(Tables(spark, sf)), "date", "catalog_id", "price_numeric")
    return _cells(wide, "date", lambda c: F.round(1000 * F.col(c)).cast("bigint").cast("string"))


def pivot_median(df, rows, columns, value):
    """Rows x values of ``columns`` with the exact median of ``value``, null where there is none."""
    q = quantiles(df.filter(F.col(columns).isNotNull()), value, [0.5], [rows, columns])
    wide = q.withColumn("_m", F.get("_q", F.lit(0))).groupBy(rows).pivot(columns).agg(F.first("_m"))
    return join_groups(df.select(rows).distinct(), wide, [rows])


@register("grand_total_level", "E11", sql="""
SELECT 'Total' AS level, date, SUM(qtt) AS qtt FROM demand GROUP BY date""")
def grand_total_level(spark, sf):
    return (demand(Tables(spark, sf)).groupBy("date").agg(F.sum("qtt").alias("qtt"))
            .select(F.lit("Total").alias("level"), "date", "qtt"))


@register("hierarchy_rollup", "E12", sql="""
SELECT nome_top_parent, family_id, CAST(GROUPING(nome_top_parent, family_id) AS INTEGER) AS level_id,
       SUM(qtt) AS qtt, round(SUM(ettdeb), 4) AS ettdeb
FROM demand GROUP BY ROLLUP (nome_top_parent, family_id)""")
def hierarchy_rollup(spark, sf):
    d = demand(Tables(spark, sf))
    return (d.rollup("nome_top_parent", "family_id")
            .agg(F.grouping_id().cast("int").alias("level_id"), F.sum("qtt").alias("qtt"),
                 F.round(F.sum("ettdeb"), 4).alias("ettdeb")))


@register("brand_size_status_cube", "E13", sql="""
SELECT brand_title, size_title, status, COUNT(*) AS n, round(SUM(price_numeric), 2) AS value
FROM tracking GROUP BY CUBE (brand_title, size_title, status)""")
def brand_size_status_cube(spark, sf):
    return (tracking(Tables(spark, sf)).cube("brand_title", "size_title", "status")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price_numeric"), 2).alias("value")))


@register("group_describe", "E14", sql="""
SELECT catalog_id, COUNT(price_numeric) AS count, round(SUM(price_numeric), 2) / COUNT(price_numeric) AS mean,
       round(stddev_samp(price_numeric), 4) AS std, MIN(price_numeric) AS min,
       quantile_cont(price_numeric, 0.25) AS q25, quantile_cont(price_numeric, 0.5) AS q50,
       quantile_cont(price_numeric, 0.75) AS q75, MAX(price_numeric) AS max
FROM tracking GROUP BY catalog_id""")
def group_describe(spark, sf):
    return describe_numeric(tracking(Tables(spark, sf)), "price_numeric", ["catalog_id"])


@register("frame_describe_numeric", "E15", sql="""
WITH long AS (
  SELECT 'price_numeric' AS variable, price_numeric AS value FROM tracking
  UNION ALL SELECT 'view_count', view_count FROM tracking
  UNION ALL SELECT 'discount', discount FROM tracking)
SELECT variable, COUNT(value) AS count, round(AVG(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
       MIN(value) AS min, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
       quantile_cont(value, 0.75) AS q75, MAX(value) AS max
FROM long GROUP BY variable""")
def frame_describe_numeric(spark, sf):
    tr = tracking(Tables(spark, sf))
    long = tr.unpivot([], ["price_numeric", "view_count", "discount"], "variable", "value")
    return describe_numeric(long, "value", ["variable"], money=False)


@register("frame_describe_object", "E15", sql="""
WITH long AS (
  SELECT 'brand_title' AS variable, brand_title AS value FROM tracking
  UNION ALL SELECT 'catalog_id', catalog_id FROM tracking
  UNION ALL SELECT 'status', status FROM tracking),
counts AS (SELECT variable, value, COUNT(*) AS c FROM long GROUP BY variable, value)
SELECT variable, CAST(SUM(c) AS BIGINT) AS count, COUNT(*) AS "unique",
       arg_min(value, (-c, value)) AS top, MAX(c) AS freq
FROM counts GROUP BY variable""")
def frame_describe_object(spark, sf):
    return describe_categorical(tracking(Tables(spark, sf)), ["brand_title", "catalog_id", "status"])


@register("skewness_by_catalog", "E16", sql="""
SELECT catalog_id, round(skewness(price_numeric), 6) AS skew FROM tracking GROUP BY catalog_id""")
def skewness_by_catalog(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("catalog_id").agg(F.round(skewness_corrected("price_numeric"), 6).alias("skew"))


_SELLER_FEATURES = ["count_products", "sum_price", "avg_views", "avg_package_size"]


def _seller_features(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("user_id").agg(
        F.countDistinct("product_id").cast("double").alias("count_products"),
        F.sum("price_numeric").alias("sum_price"), F.avg("view_count").alias("avg_views"),
        F.avg("package_size_id").alias("avg_package_size"))


_SELLER_SQL = """seller AS (
  SELECT user_id, CAST(COUNT(DISTINCT product_id) AS DOUBLE) AS count_products,
         SUM(price_numeric) AS sum_price, AVG(view_count) AS avg_views,
         AVG(package_size_id) AS avg_package_size
  FROM tracking GROUP BY user_id)"""


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i:]]


@register("seller_correlation_matrix", "E17", sql="WITH " + _SELLER_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS corr FROM seller"
    for a, b in _pairs(_SELLER_FEATURES)))
def seller_correlation_matrix(spark, sf):
    s = _seller_features(spark, sf)
    pairs = _pairs(_SELLER_FEATURES)
    row = s.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                               F.round(F.col(f"{a}__{b}"), 6).alias("corr")) for a, b in pairs])
    return row.select(F.inline(stack))


@register("catalog_price_covariance", "E18", sql="""
WITH daily AS (
  SELECT date, catalog_id, quantile_cont(price_numeric, 0.5) AS price
  FROM tracking WHERE date >= (SELECT MAX(date) FROM tracking) - INTERVAL 365 DAY
  GROUP BY date, catalog_id)
SELECT a.catalog_id AS asset_a, b.catalog_id AS asset_b, round(covar_samp(a.price, b.price), 2) AS cov
FROM daily a JOIN daily b ON a.date = b.date
GROUP BY a.catalog_id, b.catalog_id""")
def catalog_price_covariance(spark, sf):
    from mercato.operators.portfolio import MOST_COVARIANCE_ASSETS, asset_covariance, daily_asset_prices, price_assets
    prices = daily_asset_prices(tracking(Tables(spark, sf)), 365)
    cov = asset_covariance(prices, price_assets(prices, MOST_COVARIANCE_ASSETS))
    return cov.select("asset_a", "asset_b", F.round("cov", 2).alias("cov"))


@register("seasonality_hour_median", "E20", sql="""
SELECT hour(ts) AS hour, quantile_cont(value, 0.5) AS median_value, COUNT(*) AS n
FROM events GROUP BY hour(ts)""")
def seasonality_hour_median(spark, sf):
    e = Tables(spark, sf).events
    e = e.select(F.hour("ts").alias("hour"), "value")
    g = e.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    return join_groups(g, quantiles(e, "value", [0.5], ["hour"]), ["hour"]).select(
        "hour", F.get("_q", F.lit(0)).alias("median_value"), "n")


@register("seasonality_weekday_hour_mean", "E20", sql="""
SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, round(AVG(value), 4) AS mean_value
FROM events GROUP BY weekday, hour""")
def seasonality_weekday_hour_mean(spark, sf):
    e = Tables(spark, sf).events
    return (e.groupBy(F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour"))
            .agg(F.round(F.avg("value"), 4).alias("mean_value")))


@register("catalog_brand_members", "E21", sql="""
SELECT catalog_id, array_to_string(list_sort(list(DISTINCT brand_title)), ',') AS brands,
       COUNT(DISTINCT brand_title) AS n_brands
FROM tracking GROUP BY catalog_id""")
def catalog_brand_members(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("catalog_id").agg(
        F.array_join(F.sort_array(F.collect_set("brand_title")), ",").alias("brands"),
        F.countDistinct("brand_title").alias("n_brands"))


@register("month_end_resample", "E22", sql="""
SELECT family_id, last_day(date) AS month_end, SUM(qtt) AS qtt FROM demand GROUP BY family_id, month_end""")
def month_end_resample(spark, sf):
    d = demand(Tables(spark, sf))
    return d.groupBy("family_id", F.last_day("date").alias("month_end")).agg(F.sum("qtt").alias("qtt"))


@register("hourly_grid_events", "E23", sql="""
WITH hourly AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n, round(SUM(value), 4) AS value
                FROM events GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT MIN(hour) FROM hourly), (SELECT MAX(hour) FROM hourly),
                                       INTERVAL 1 HOUR)) AS hour)
SELECT g.hour, h.n, h.value FROM grid g LEFT JOIN hourly h ON g.hour = h.hour""")
def hourly_grid_events(spark, sf):
    from mercato.operators.relational import reconcile
    e = Tables(spark, sf).events
    hourly = e.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))
    hourly = hourly.withColumn("_k", F.lit(1))
    return reconcile(hourly, ["_k"], "hour", ["n", "value"], step="1 hour", fill=None).drop("_k")


@register("monthly_category_counts", "E24+M4", sql="""
SELECT catalog_id, CAST(date_trunc('month', date) AS DATE) AS month,
       COUNT(*) AS count_articles, round(SUM(price_numeric), 2) AS sum_price, SUM(view_count) AS sum_views
FROM tracking GROUP BY catalog_id, month""")
def monthly_category_counts(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("catalog_id", F.trunc("date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("count_articles"),
        F.round(F.sum("price_numeric"), 2).alias("sum_price"), F.sum("view_count").alias("sum_views"))


@register("brand_dashboard", "E25+H17", sql="""
SELECT brand_title, COUNT(DISTINCT product_id) AS products,
       quantile_cont(price_numeric, 0.5) AS median_price, round(stddev_samp(price_numeric), 4) AS std_price,
       round(SUM(price_numeric), 2) AS total_volume,
       printf('%.2f €', round(quantile_cont(price_numeric, 0.5), 2)) AS median_label
FROM tracking GROUP BY brand_title""")
def brand_dashboard(spark, sf):
    tr = tracking(Tables(spark, sf))
    g = tr.groupBy("brand_title").agg(
        F.countDistinct("product_id").alias("products"), F.round(F.stddev_samp("price_numeric"), 4).alias("std_price"),
        F.round(F.sum("price_numeric"), 2).alias("total_volume"))
    x = join_groups(g, quantiles(tr, "price_numeric", [0.5], ["brand_title"]), ["brand_title"])
    return x.withColumn("median_price", F.get("_q", F.lit(0))).drop("_q").withColumn(
        "median_label", F.format_string("%.2f €", F.round("median_price", 2)))


@register("cluster_shares", "E26", sql="""
SELECT label, COUNT(*) AS n, round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 4) AS pct,
       printf('%.2f%%', 100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()) AS pct_label
FROM embeddings GROUP BY label""")
def cluster_shares(spark, sf):
    e = Tables(spark, sf).embeddings
    # The window runs over the per-label counts (one row per label), not over rows.
    counts = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.select("label", "n", F.round(share, 4).alias("pct"),
                         F.format_string("%.2f%%", share).alias("pct_label"))


@register("cluster_profile", "E27", sql="""
SELECT label, dim, round(100 * AVG(v), 4) AS mean_pct
FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS dim FROM embeddings) GROUP BY label, dim""")
def cluster_profile(spark, sf):
    """Mean of every feature by label, one row per label and feature."""
    e = Tables(spark, sf).embeddings.select("label", F.posexplode("embedding").alias("dim", "v"))
    return e.groupBy("label", F.col("dim").cast("bigint").alias("dim")).agg(F.round(100 * F.avg("v"), 4).alias("mean_pct"))


@register("cluster_top_composition", "E28+G1", sql="""
WITH c AS (SELECT catalog_id, size_title, COUNT(*) AS n FROM tracking GROUP BY catalog_id, size_title),
r AS (SELECT *, row_number() OVER (PARTITION BY catalog_id ORDER BY n DESC, size_title) AS rk,
             SUM(n) OVER (PARTITION BY catalog_id) AS total FROM c)
SELECT catalog_id, size_title, n, rk, round(n / total, 6) AS share FROM r WHERE rk <= 10""")
def cluster_top_composition(spark, sf):
    tr = tracking(Tables(spark, sf))
    # Windows run over (catalog, size) counts: at most |catalogs| x |sizes| rows.
    c = tr.groupBy("catalog_id", "size_title").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("catalog_id")
    r = c.select("*", F.row_number().over(w.orderBy(F.desc("n"), "size_title")).alias("rk"),
                 F.sum("n").over(w).alias("total"))
    return r.filter("rk <= 10").select("catalog_id", "size_title", "n", F.col("rk").cast("bigint").alias("rk"),
                                       F.round(F.col("n") / F.col("total"), 6).alias("share"))


@register("price_histogram", "E29", sql="""
WITH b AS (SELECT MIN(price_numeric) AS lo, MAX(price_numeric) AS hi FROM tracking),
x AS (SELECT LEAST(CAST(floor((price_numeric - lo) / (hi - lo) * 20) AS INTEGER) + 1, 20) AS bin, lo, hi
      FROM tracking, b)
SELECT bin, COUNT(*) AS n, round(lo + (bin - 1) * (hi - lo) / 20, 4) AS bin_lo,
       round(lo + bin * (hi - lo) / 20, 4) AS bin_hi
FROM x GROUP BY bin, lo, hi""")
def price_histogram(spark, sf):
    return fixed_bins(tracking(Tables(spark, sf)), "price_numeric", 20)


@register("price_histogram_by_status", "E29", sql="""
WITH b AS (SELECT status, MIN(price_numeric) AS lo, MAX(price_numeric) AS hi FROM tracking GROUP BY status),
x AS (SELECT t.status, LEAST(CAST(floor((price_numeric - lo) / (hi - lo) * 30) AS INTEGER) + 1, 30) AS bin, lo, hi
      FROM tracking t JOIN b ON t.status = b.status)
SELECT status, bin, COUNT(*) AS n, round(lo + (bin - 1) * (hi - lo) / 30, 4) AS bin_lo,
       round(lo + bin * (hi - lo) / 30, 4) AS bin_hi
FROM x GROUP BY status, bin, lo, hi""")
def price_histogram_by_status(spark, sf):
    return fixed_bins(tracking(Tables(spark, sf)), "price_numeric", 30, by=["status"])


@register("price_box_whiskers", "E30", sql="""
WITH q AS (SELECT catalog_id, quantile_cont(price_numeric, 0.25) AS q1, quantile_cont(price_numeric, 0.5) AS med,
                  quantile_cont(price_numeric, 0.75) AS q3 FROM tracking GROUP BY catalog_id)
SELECT t.catalog_id, round(q.q1, 4) AS q1, round(q.med, 4) AS median, round(q.q3, 4) AS q3,
       round(q.q3 - q.q1, 4) AS iqr,
       MIN(price_numeric) FILTER (WHERE price_numeric >= q.q1 - 1.5 * (q.q3 - q.q1)) AS lower_whisker,
       MAX(price_numeric) FILTER (WHERE price_numeric <= q.q3 + 1.5 * (q.q3 - q.q1)) AS upper_whisker,
       COUNT(*) FILTER (WHERE price_numeric < q.q1 - 1.5 * (q.q3 - q.q1)
                           OR price_numeric > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM tracking t JOIN q ON t.catalog_id = q.catalog_id
GROUP BY t.catalog_id, q.q1, q.med, q.q3""")
def price_box_whiskers(spark, sf):
    return box_whiskers(tracking(Tables(spark, sf)), "price_numeric", ["catalog_id"])


@register("category_leadership", "E33", sql="""
WITH v AS (SELECT c.c_nationkey AS city, p.p_type AS category, SUM(l.l_extendedprice) AS value
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
           GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY city ORDER BY round(value, 2) DESC) AS rk FROM v)
SELECT category, COUNT(DISTINCT city) AS count_location_city FROM r WHERE rk = 1 GROUP BY category""")
def category_leadership(spark, sf):
    t = Tables(spark, sf)
    li, o, c, p = t.lineitem, t.orders, t.customer, t.part
    v = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(p, li.l_partkey == p.p_partkey)
         .groupBy(F.col("c_nationkey").alias("city"), F.col("p_type").alias("category"))
         .agg(F.sum("l_extendedprice").alias("value")))
    # Ranking runs over (city, category) totals, bounded by |cities| x |categories|.
    rk = F.rank().over(Window.partitionBy("city").orderBy(F.desc(F.round("value", 2))))
    return (v.withColumn("rk", rk).filter("rk = 1").groupBy("category")
            .agg(F.countDistinct("city").alias("count_location_city")))


@register("top_cities_by_value", "E34+G1", sql="""
SELECT n.n_name AS location_city, COUNT(DISTINCT o.o_custkey) AS unique_users,
       COUNT(DISTINCT l.l_partkey) AS count_articles, round(SUM(l.l_extendedprice), 2) AS sum_price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY sum_price DESC, location_city LIMIT 10""")
def top_cities_by_value(spark, sf):
    t = Tables(spark, sf)
    li, o, c, n = t.lineitem, t.orders, t.customer, t.nation
    g = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation: 25 rows by definition
         .groupBy(F.col("n_name").alias("location_city"))
         .agg(F.countDistinct("o_custkey").alias("unique_users"),
              F.countDistinct("l_partkey").alias("count_articles"),
              F.round(F.sum("l_extendedprice"), 2).alias("sum_price")))
    return g.orderBy(F.desc("sum_price"), "location_city").limit(10)


@register("column_nunique", "E35", sql="""
SELECT COUNT(DISTINCT product_id) AS product_id, COUNT(DISTINCT user_id) AS user_id,
       COUNT(DISTINCT catalog_id) AS catalog_id, COUNT(DISTINCT brand_title) AS brand_title,
       COUNT(DISTINCT size_title) AS size_title, COUNT(DISTINCT status) AS status,
       COUNT(DISTINCT date) AS date FROM tracking""")
def column_nunique(spark, sf):
    tr = tracking(Tables(spark, sf))
    cols = ["product_id", "user_id", "catalog_id", "brand_title", "size_title", "status", "date"]
    return tr.agg(*[F.countDistinct(c).alias(c) for c in cols])


@register("brand_money_avg", "E25", sql="""
SELECT brand_title, round(SUM(price_numeric), 2) / COUNT(price_numeric) AS avg_price,
       MIN(price_numeric) AS min_price, MAX(price_numeric) AS max_price
FROM tracking GROUP BY brand_title""")
def brand_money_avg(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("brand_title").agg(money_avg("price_numeric").alias("avg_price"),
                                         F.min("price_numeric").alias("min_price"),
                                         F.max("price_numeric").alias("max_price"))
