"""Statistics, evaluation, embeddings and baskets (SURVEY §2.J J6-J9,
§2.K K1, K9-K14, K17, K18, K22, K26-K29, §2.D D11, E31)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import embeddings as EMB
from mercato.operators.hypothesis import (
    chi2_sf, ks_statistic, kruskal_wallis, normal_cdf_sql, normal_ppf, studentized_range_quantile, studentized_range_sf, tukey_pairs,
)
from mercato.operators.portfolio import MOST_COVARIANCE_ASSETS, asset_covariance, basket_metrics, daily_asset_prices, price_assets
from mercato.operators.ranges import if_small, join_groups
from mercato.operators.ranking import rank_table
from mercato.plans.registry import register
from mercato.sources.tables import Tables, tracking


@register("kruskal_wallis_h", "J6", sql="""
WITH r AS (SELECT catalog_id AS g,
                  rank() OVER (ORDER BY price_numeric) + (COUNT(*) OVER (PARTITION BY price_numeric) - 1) / 2.0 AS rk
           FROM tracking),
s AS (SELECT g, SUM(rk) AS R, COUNT(*) AS ng FROM r GROUP BY g),
t AS (SELECT CAST(COUNT(*) AS DOUBLE) AS c FROM tracking GROUP BY price_numeric),
nn AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM tracking)
SELECT round((12.0 / (nn.n * (nn.n + 1)) * (SELECT SUM(R * R / ng) FROM s) - 3 * (nn.n + 1))
             / (1 - (SELECT SUM(c * c * c - c) FROM t) / (nn.n * nn.n * nn.n - nn.n)), 6) AS H,
       CAST((SELECT COUNT(*) FROM s) - 1 AS INTEGER) AS dof, CAST(nn.n AS BIGINT) AS n FROM nn""")
def kruskal_wallis_h(spark, sf):
    kw = kruskal_wallis(tracking(Tables(spark, sf)), "catalog_id", "price_numeric")
    return kw.select(F.round("H", 6).alias("H"), "dof", "n")


@register("kruskal_wallis_test", "J6")
def kruskal_wallis_test(spark, sf):
    kw = kruskal_wallis(tracking(Tables(spark, sf)), "catalog_id", "price_numeric")
    return kw.withColumn("p_value", chi2_sf(F.col("H"), F.col("dof").cast("double")))


@register("tukey_meandiff", "J7", sql="""
WITH g AS (SELECT catalog_id, COUNT(*) AS n, AVG(price_numeric) AS mean, var_samp(price_numeric) AS var
           FROM tracking GROUP BY catalog_id),
m AS (SELECT SUM((n - 1) * var) / (SUM(n) - COUNT(*)) AS mse FROM g)
SELECT a.catalog_id AS group1, b.catalog_id AS group2, round(b.mean - a.mean, 4) AS meandiff,
       round(abs(b.mean - a.mean) / sqrt(m.mse / 2.0 * (1.0 / a.n + 1.0 / b.n)), 4) AS q
FROM g a JOIN g b ON a.catalog_id < b.catalog_id, m""")
def tukey_meandiff(spark, sf):
    t = tukey_pairs(tracking(Tables(spark, sf)), "catalog_id", "price_numeric")
    return t.select("group1", "group2", F.round("meandiff", 4).alias("meandiff"), F.round("q", 4).alias("q"))


@register("tukey_hsd", "J7")
def tukey_hsd(spark, sf):
    """Differences with p-values and 95 % intervals of the studentised range with the residual degrees of freedom."""
    t = tukey_pairs(tracking(Tables(spark, sf)), "catalog_id", "price_numeric")
    half = studentized_range_quantile(F.lit(0.95), F.col("k"), F.col("df")) * F.col("se")
    return (t.withColumn("p_adj", studentized_range_sf(F.col("q"), F.col("k"), F.col("df")))
            .withColumn("lower", F.col("meandiff") - half).withColumn("upper", F.col("meandiff") + half)
            .withColumn("reject", F.col("p_adj") < 0.05))


@register("ks_statistic_normal", "J8", sql=f"""
WITH x AS (SELECT ln(price_numeric) AS x FROM tracking),
s AS (SELECT AVG(x) AS mu, stddev_samp(x) AS sd, CAST(COUNT(*) AS DOUBLE) AS n FROM x),
c AS (SELECT (x - s.mu) / s.sd AS z, COUNT(*) AS c FROM x, s GROUP BY 1),
r AS (SELECT z, c, COALESCE(SUM(c) OVER (ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM c)
SELECT round(MAX(greatest((below + c) / s.n - {normal_cdf_sql('z')}, {normal_cdf_sql('z')} - below / s.n)), 6) AS D,
       s.n AS n
FROM r, s GROUP BY s.n""")
def ks_statistic_normal(spark, sf):
    tr = tracking(Tables(spark, sf)).select(F.ln("price_numeric").alias("x"))
    return ks_statistic(tr, "x").select(F.round("D", 6).alias("D"), "n")


@register("ks_test_mllib", "J8")
def ks_test_mllib(spark, sf):
    from pyspark.ml.stat import KolmogorovSmirnovTest
    tr = tracking(Tables(spark, sf)).select(F.ln("price_numeric").alias("x"))
    s = tr.agg(F.avg("x").alias("mu"), F.stddev_samp("x").alias("sd"))
    z = tr.select(((F.col("x") - s.select("mu").scalar()) / s.select("sd").scalar()).alias("z"))
    return KolmogorovSmirnovTest.test(z, "z", "norm", 0.0, 1.0)


@register("qq_points", "J9")
def qq_points(spark, sf):
    """Sample vs normal quantiles per distinct standardised value (mid-rank positions)."""
    tr = tracking(Tables(spark, sf)).select(F.ln("price_numeric").alias("x"))
    s = tr.agg(F.avg("x").alias("mu"), F.stddev_samp("x").alias("sd"), F.count(F.lit(1)).alias("n"))
    z = tr.select(((F.col("x") - s.select("mu").scalar()) / s.select("sd").scalar()).alias("z"))
    r = rank_table(z, "z")
    p = (F.col("avg_rank") - 0.5) / s.select("n").scalar()
    return r.select("z", "c", p.alias("p"), normal_ppf(p).alias("theoretical"))


_PRED_SQL = """WITH m AS (SELECT catalog_id, AVG(price_numeric) AS yhat FROM tracking GROUP BY catalog_id),
p AS (SELECT t.brand_title, t.price_numeric AS y, m.yhat FROM tracking t JOIN m ON t.catalog_id = m.catalog_id)"""


def _predictions(spark, sf):
    tr = tracking(Tables(spark, sf))
    m = tr.groupBy("catalog_id").agg(F.avg("price_numeric").alias("yhat"))
    return join_groups(tr.filter("catalog_id is not null"), m, ["catalog_id"], "inner").select(
        "brand_title", F.col("price_numeric").alias("y"), "yhat")


@register("regression_metrics", "K9", sql=_PRED_SQL + """
SELECT round(AVG((y - yhat) * (y - yhat)), 2) AS mse, round(sqrt(AVG((y - yhat) * (y - yhat))), 4) AS rmse,
       round(AVG(abs(y - yhat)), 4) AS mae, round(quantile_cont(abs(y - yhat), 0.5), 4) AS medae,
       round(1 - SUM((y - yhat) * (y - yhat)) / (var_pop(y) * COUNT(*)), 6) AS r2,
       round(AVG(abs(y - yhat) / abs(y)), 6) AS mape,
       round(1 - var_pop(y - yhat) / var_pop(y), 6) AS explained_variance,
       round(MAX(abs(y - yhat)), 4) AS max_error
FROM p""")
def regression_metrics(spark, sf):
    from mercato.operators.evaluation import regression_summary
    return regression_summary(_predictions(spark, sf), "y", "yhat")


@register("per_group_mse", "K10", sql=_PRED_SQL + """
SELECT brand_title, COUNT(*) AS n, round(AVG((y - yhat) * (y - yhat)), 2) AS mse FROM p GROUP BY brand_title""")
def per_group_mse(spark, sf):
    p = _predictions(spark, sf)
    err = (F.col("y") - F.col("yhat")) * (F.col("y") - F.col("yhat"))
    return p.groupBy("brand_title").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(err), 2).alias("mse"))


_CLS_SQL = """WITH d AS (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS score,
                  CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS pred
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _scored(spark, sf):
    t = Tables(spark, sf)
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return d.select(F.col("quality").alias("y"), F.col("n_chars").cast("double").alias("score"),
                    F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("pred"))


@register("classification_metrics", "K11", sql=_CLS_SQL + """,
r AS (SELECT y, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM d),
a AS (SELECT (SUM(rk) FILTER (WHERE y = 1) - COUNT(*) FILTER (WHERE y = 1) * (COUNT(*) FILTER (WHERE y = 1) + 1) / 2.0)
             / (COUNT(*) FILTER (WHERE y = 1) * COUNT(*) FILTER (WHERE y = 0)) AS auc FROM r)
SELECT round(AVG(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(SUM(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) / SUM(CASE WHEN y = 1 THEN 1.0 ELSE 0 END), 6) AS recall,
       round(SUM(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) / SUM(CASE WHEN y = 0 THEN 1.0 ELSE 0 END), 6)
         AS specificity,
       round(SUM(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) / SUM(CASE WHEN pred = 1 THEN 1.0 ELSE 0 END), 6)
         AS precision,
       round((SELECT auc FROM a), 6) AS auc
FROM d""")
def classification_metrics(spark, sf):
    from mercato.operators.evaluation import binary_summary
    return binary_summary(_scored(spark, sf), "y", "pred", "score")


@register("confusion_matrix", "K12", sql=_CLS_SQL + """
SELECT y, pred, COUNT(*) AS n, round(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY y), 6) AS share
FROM d GROUP BY y, pred""")
def confusion_matrix(spark, sf):
    c = _scored(spark, sf).groupBy("y", "pred").agg(F.count(F.lit(1)).alias("n"))
    # The window runs over the (label, prediction) cells only.
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("y")), 6))


@register("roc_points", "K14", sql=_CLS_SQL + """,
c AS (SELECT score, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y = 0) AS neg FROM d GROUP BY score),
t AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM c),
r AS (SELECT score, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM c
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT score AS threshold, round(tp / t.P, 6) AS tpr, round(fp / t.N, 6) AS fpr FROM r, t""")
def roc_points(spark, sf):
    from mercato.operators.evaluation import roc_curve
    return roc_curve(_scored(spark, sf), "y", "score")


_CENT_SQL = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cells AS (SELECT label, i, AVG(v[i]) AS m, COUNT(*) AS n
          FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i),
c AS (SELECT label, MAX(n) AS n, list(m ORDER BY i) AS centroid FROM cells GROUP BY label),
s AS (SELECT e.vec_id, e.label, c.label AS cand, list_cosine_similarity(e.v, c.centroid) AS score FROM e, c),
b AS (SELECT vec_id, label, arg_max(cand, (score, -cand)) AS nearest, MAX(score) AS score,
             MAX(score) FILTER (WHERE cand = label) AS own_score FROM s GROUP BY vec_id, label)"""


@register("entity_mapping_cosine", "K28", sql=_CENT_SQL + """
SELECT vec_id, label, nearest, round(score, 6) AS score, round(own_score, 6) AS own_score,
       CASE WHEN score > 0.3 THEN 1 ELSE 0 END AS kept FROM b""")
def entity_mapping_cosine(spark, sf):
    nc = EMB.nearest_centroid(Tables(spark, sf).embeddings, "vec_id", "label", "embedding")
    return nc.select("vec_id", "label", "nearest", F.round("score", 6).alias("score"),
                     F.round("own_score", 6).alias("own_score"),
                     F.when(F.col("score") > 0.3, 1).otherwise(0).alias("kept"))


@register("embedding_class_outliers", "K29", sql=_CENT_SQL + """
SELECT vec_id, label, nearest, round(score - own_score, 6) AS margin FROM b WHERE nearest <> label""")
def embedding_class_outliers(spark, sf):
    nc = EMB.nearest_centroid(Tables(spark, sf).embeddings, "vec_id", "label", "embedding")
    return nc.filter(F.col("nearest") != F.col("label")).select(
        "vec_id", "label", "nearest", F.round(F.col("score") - F.col("own_score"), 6).alias("margin"))


@register("per_class_prf", "K13", sql=_CENT_SQL + """,
k AS (SELECT label AS cls FROM c),
m AS (SELECT k.cls, COUNT(*) FILTER (WHERE b.label = k.cls AND b.nearest = k.cls) AS tp,
             COUNT(*) FILTER (WHERE b.label = k.cls) AS support, COUNT(*) FILTER (WHERE b.nearest = k.cls) AS pred
      FROM k, b GROUP BY k.cls),
p AS (SELECT cls, support, CASE WHEN pred = 0 THEN 0.0 ELSE tp / pred END AS precision,
             CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM m),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END
                AS f1 FROM p)
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(AVG(precision), 6), round(AVG(recall), 6), round(AVG(f1), 6),
       CAST(SUM(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(SUM(precision * support) / SUM(support), 6),
       round(SUM(recall * support) / SUM(support), 6), round(SUM(f1 * support) / SUM(support), 6),
       CAST(SUM(support) AS BIGINT) FROM f""")
def per_class_prf(spark, sf):
    from mercato.operators.evaluation import class_report
    nc = EMB.nearest_centroid(Tables(spark, sf).embeddings, "vec_id", "label", "embedding")
    return class_report(nc, "label", "nearest")


@register("cluster_validity_indices", "K17", sql="""WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cells AS (SELECT label, i, AVG(v[i]) AS m, COUNT(*) AS n
          FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i),
c AS (SELECT label, MAX(n) AS n, list(m ORDER BY i) AS centroid FROM cells GROUP BY label),
gcell AS (SELECT i, AVG(v[i]) AS m FROM (SELECT v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY i),
g AS (SELECT list(m ORDER BY i) AS grand FROM gcell),
d AS (SELECT e.label, list_distance(e.v, c.centroid) AS dist FROM e JOIN c ON e.label = c.label),
s AS (SELECT label, AVG(dist) AS s, SUM(dist * dist) AS w, COUNT(*) AS n FROM d GROUP BY label),
tot AS (SELECT SUM(w) AS W, SUM(n) AS N, COUNT(*) AS k FROM s),
bb AS (SELECT SUM(c.n * list_distance(c.centroid, g.grand) ^ 2) AS B FROM c, g),
r AS (SELECT a.label, MAX((sa.s + sb.s) / list_distance(a.centroid, b.centroid)) AS worst
      FROM c a JOIN c b ON a.label <> b.label JOIN s sa ON sa.label = a.label JOIN s sb ON sb.label = b.label
      GROUP BY a.label)
SELECT round((bb.B / (tot.k - 1)) / (tot.W / (tot.N - tot.k)), 6) AS calinski_harabasz,
       round((SELECT AVG(worst) FROM r), 6) AS davies_bouldin FROM bb, tot""")
def cluster_validity_indices(spark, sf):
    return EMB.cluster_indices(Tables(spark, sf).embeddings, "label", "embedding")


@register("ward_merge_costs", "K18", sql="""WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cells AS (SELECT label, i, AVG(v[i]) AS m, COUNT(*) AS n
          FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i),
c AS (SELECT label, MAX(n) AS n, list(m ORDER BY i) AS centroid FROM cells GROUP BY label)
SELECT a.label AS label_a, b.label AS label_b,
       round(CAST(a.n AS DOUBLE) * b.n / (a.n + b.n) * list_distance(a.centroid, b.centroid) ^ 2, 6) AS ward_delta
FROM c a JOIN c b ON a.label < b.label""")
def ward_merge_costs(spark, sf):
    return EMB.ward_merge_costs(Tables(spark, sf).embeddings, "label", "embedding")


_BASKET_SQL = """WITH daily AS (
  SELECT date, catalog_id AS asset, quantile_cont(price_numeric, 0.5) AS price FROM tracking
  WHERE date >= (SELECT MAX(date) FROM tracking) - INTERVAL 365 DAY GROUP BY date, catalog_id),
st AS (SELECT asset, quantile_cont(price, 0.5) AS med, quantile_cont(price, 0.05) AS q05,
              CAST(row_number() OVER (ORDER BY asset) - 1 AS BIGINT) AS i FROM daily GROUP BY asset),
cv AS (SELECT a.asset AS aa, b.asset AS bb, covar_samp(a.price, b.price) AS cov
       FROM daily a JOIN daily b ON a.date = b.date GROUP BY 1, 2),
p AS (SELECT unnest(range(1, 64)) AS pid),
w AS (SELECT p.pid, st.asset, st.med, st.q05, CAST((p.pid >> st.i) & 1 AS DOUBLE) AS w FROM p, st),
a1 AS (SELECT pid, SUM(w * med) AS rev, SUM(w * (med - q05)) AS var_, SUM(w) AS n FROM w GROUP BY pid),
a2 AS (SELECT x.pid, SUM(x.w * y.w * cv.cov) AS v FROM w x JOIN w y ON x.pid = y.pid
       JOIN cv ON cv.aa = x.asset AND cv.bb = y.asset GROUP BY x.pid),
nv AS (SELECT (SELECT SUM(med) FROM st) / sqrt((SELECT SUM(cov) FROM cv)) AS naive),
b AS (SELECT a1.pid, a1.rev, sqrt(a2.v) AS vol, a1.var_, a1.rev / sqrt(a2.v) AS sharpe, a1.n,
             a1.rev / sqrt(a2.v) / nv.naive AS rel FROM a1 JOIN a2 ON a1.pid = a2.pid, nv)"""


@register("basket_simulation", "D11+K26", sql=_BASKET_SQL + """
SELECT pid, round(rev, 4) AS revenue, round(vol, 4) AS volatility, round(var_, 4) AS value_at_risk,
       round(sharpe, 6) AS sharpe, CAST(n AS BIGINT) AS n_assets, round(rel, 6) AS relative_sharpe FROM b""")
def basket_simulation(spark, sf):
    prices = daily_asset_prices(tracking(Tables(spark, sf)), 365)
    return basket_metrics(prices, price_assets(prices))


@register("basket_top5_vs_naive", "K27+G1", sql=_BASKET_SQL + """
SELECT pid, round(sharpe, 6) AS sharpe, round(rel, 6) AS relative_sharpe FROM b WHERE round(rel, 6) > 1
ORDER BY rel DESC, pid LIMIT 5""")
def basket_top5_vs_naive(spark, sf):
    prices = daily_asset_prices(tracking(Tables(spark, sf)), 365)
    b = basket_metrics(prices, price_assets(prices))
    return (b.filter(F.col("relative_sharpe") > 1).orderBy(F.desc("relative_sharpe"), "pid").limit(5)
            .select("pid", "sharpe", "relative_sharpe"))


@register("minmax_scaled_sellers", "K1", sql="""
WITH s AS (SELECT user_id, CAST(COUNT(*) AS DOUBLE) AS n_rows, SUM(price_numeric) AS value FROM tracking GROUP BY user_id),
b AS (SELECT MIN(n_rows) AS lo_n, MAX(n_rows) AS hi_n, MIN(value) AS lo_v, MAX(value) AS hi_v FROM s)
SELECT user_id, CASE WHEN hi_n = lo_n THEN 0.0 ELSE round((n_rows - lo_n) / (hi_n - lo_n), 6) END AS n_rows,
       CASE WHEN hi_v = lo_v THEN 0.0 ELSE round((round(value, 2) - round(lo_v, 2)) / (round(hi_v, 2) - round(lo_v, 2)), 6) END
         AS value
FROM s, b""")
def minmax_scaled_sellers(spark, sf):
    from mercato.operators.evaluation import minmax_scale
    tr = tracking(Tables(spark, sf))
    s = tr.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n_rows"),
                                  F.round(F.sum("price_numeric"), 2).alias("value"))
    return minmax_scale(s, ["n_rows", "value"], digits=6)


@register("price_kde", "E31", sql="""
WITH s AS (SELECT MIN(price_numeric) AS lo, MAX(price_numeric) AS hi, stddev_samp(price_numeric) AS sd,
                  COUNT(*)::DOUBLE AS n FROM tracking),
b AS (SELECT least(floor((price_numeric - lo) / (hi - lo) * 200)::INTEGER, 199) AS bin, COUNT(*) AS c
      FROM tracking, s GROUP BY 1),
g AS (SELECT unnest(range(100))::INTEGER AS grid_idx)
SELECT grid_idx, round(lo + grid_idx * (hi - lo) / 99.0, 4) AS x,
       round(SUM(c * exp(-0.5 * pow((lo + grid_idx * (hi - lo) / 99.0 - (lo + (bin + 0.5) * (hi - lo) / 200))
                                    / (sd * pow(n, -0.2)), 2))) / (n * sd * pow(n, -0.2) * sqrt(2 * pi())), 12) AS density
FROM g, s, b GROUP BY grid_idx, lo, hi, sd, n""")
def price_kde(spark, sf):
    """Gaussian KDE of prices on a 100-point grid, binned first (200 bins),
    Scott bandwidth.  Bins and grid are bounded; rows are only counted."""
    tr = tracking(Tables(spark, sf)).select(F.col("price_numeric").alias("x"))
    st = tr.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.stddev_samp("x").alias("sd"),
                F.count(F.lit(1)).alias("n"))
    lo, hi = st.select("lo").scalar(), st.select("hi").scalar()
    nb = 200
    b = F.least(F.floor((F.col("x") - lo) / (hi - lo) * nb).cast("int"), F.lit(nb - 1))
    bins = tr.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    packed = bins.agg(F.collect_list(F.struct("bin", "c")).alias("bins"))
    x = packed.select("bins", lo.alias("lo"), hi.alias("hi"), st.select("sd").scalar().alias("sd"),
                      st.select("n").scalar().alias("n"))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), -0.2)
    grid = x.select("*", h.alias("h"), F.explode(F.sequence(F.lit(0), F.lit(99))).alias("g"))
    gx = F.col("lo") + F.col("g") * (F.col("hi") - F.col("lo")) / 99.0
    center = lambda bn: F.col("lo") + (bn + 0.5) * (F.col("hi") - F.col("lo")) / nb
    dens = F.aggregate(F.col("bins"), F.lit(0.0), lambda acc, s: acc + s["c"] * F.exp(
        -0.5 * F.pow((gx - center(s["bin"])) / F.col("h"), 2))) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return grid.select(F.col("g").alias("grid_idx"), F.round(gx, 4).alias("x"), F.round(dens, 12).alias("density"))


@register("partial_correlation_edges", "K22")
def partial_correlation_edges(spark, sf):
    """Partial correlations from the ridge-regularised inverse covariance of
    the catalogue price series; the k x k inversion runs in one small group."""
    prices = daily_asset_prices(tracking(Tables(spark, sf)), 365)
    cov = asset_covariance(prices, price_assets(prices, MOST_COVARIANCE_ASSETS)).withColumn("_g", F.lit(0))

    def invert(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["asset_a"]))
        idx = {n: i for i, n in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        for a, b, c in zip(pdf["asset_a"], pdf["asset_b"], pdf["cov"]):
            m[idx[a], idx[b]] = c
        sd = np.sqrt(np.diag(m))
        corr = m / np.outer(sd, sd) + 1e-3 * np.eye(len(names))
        prec = np.linalg.inv(corr)
        d = np.sqrt(np.diag(prec))
        pc = -prec / np.outer(d, d)
        rows = [(names[i], names[j], float(pc[i, j])) for i in range(len(names)) for j in range(i + 1, len(names))]
        out = pd.DataFrame(rows, columns=["asset_a", "asset_b", "partial_corr"])
        out["edge"] = out.partial_corr.abs() > 0.07
        return out

    return cov.groupBy("_g").applyInPandas(invert, "asset_a string, asset_b string, partial_corr double, edge boolean")
