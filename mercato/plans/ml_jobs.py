"""Model jobs on ``pyspark.ml``, all seeded.  The driver's tables are random, so models find little in
them; ``tests/test_models.py`` runs the operators on fixtures with a planted signal."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import boosting as B
from mercato.operators import dtw as D
from mercato.operators import ml as M
from mercato.operators.embeddings import cluster_sse
from mercato.operators.evaluation import class_report
from mercato.operators.portfolio import basket_metrics, daily_asset_prices, price_assets
from mercato.operators.series import family_daily, standard_series
from mercato.operators.ranges import quantile_scalars
from mercato.plans.registry import register
from mercato.session import ensure_checkpoint_dir
from mercato.sources.tables import Tables, demand, tracking

CATS = ["catalog_id", "brand_title", "size_title", "status"]
NUMS = ["view_count", "discount", "package_size_d"]
#: Days of history that the lookback comparison gives a model.
LOOKBACKS = (7, 30, 180, 365, 545)


#: The columns that boosted trees read: the categories' numbers and the numeric ones.
TREE_COLS = [*[f"{c}_idx" for c in CATS], *NUMS]


def _tracking_features(spark, sf, deal=M.even_parts):
    """Rows with their one-hot features, and the fitted pipeline.  The joined rows are written once, in parts of bounded size:
    the indexers, every pass of a fit and every evaluation read those."""
    tr = tracking(Tables(spark, sf)).withColumn("package_size_d", F.col("package_size_id").cast("double"))
    tr = tr.withColumn("label", F.col("price_numeric")).withColumn(
        "fold", M.hash_fold("order_id", "package_size_id", k=5))
    tr = deal(tr.select(*CATS, *NUMS, "package_size_id", "order_id", "price_numeric", "label", "fold"))
    model = M.onehot_pipeline(CATS, NUMS).fit(tr)
    return model.transform(tr), model


def _boosted(train, sizes, maxBins=32, seed=42, **params):
    """Boosted trees on the rows ``train`` of ``_tracking_features``."""
    binned = B.Binned(train, TREE_COLS[: len(CATS)], sizes, NUMS, "label", maxBins, seed)
    model = B.fit(binned, seed=seed, **params)
    binned.release()
    return model


@register("onehot_features", "K2+C12", sql="""
WITH k AS (SELECT CAST(COUNT(DISTINCT catalog_id) + COUNT(DISTINCT brand_title) + COUNT(DISTINCT size_title)
                       + COUNT(DISTINCT status) + 4 * 2 + 3 AS INTEGER) AS n FROM tracking)
SELECT order_id, package_size_id, n AS n_features,
       4 + (view_count <> 0)::INTEGER + (discount <> 0)::INTEGER + (package_size_id <> 0)::INTEGER AS nnz
FROM tracking, k""")
def onehot_features(spark, sf):
    x, _ = _tracking_features(spark, sf)
    arr = vector_to_array("features")
    return x.select("order_id", "package_size_id", F.size(arr).alias("n_features"),
                    F.size(F.filter(arr, lambda v: v != 0)).alias("nnz"))


@register("gbt_price_regression", "K3+K9")
def gbt_price_regression(spark, sf):
    x, _ = _tracking_features(spark, sf, M.even_files)
    train, test = x.filter("fold <> 0"), x.filter("fold = 0")
    m = _boosted(train, M.onehot_sizes(x, CATS), maxIter=20, maxDepth=5, maxBins=64, seed=42)
    return M.regression_report(m.transform(test))


@register("gbt_early_stopping", "K32")
def gbt_early_stopping(spark, sf):
    x, _ = _tracking_features(spark, sf)
    x = x.filter("fold <> 0").withColumn("is_val", F.col("fold") == 1)
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=60, maxDepth=4, maxBins=64, seed=42,
                       validationIndicatorCol="is_val", validationTol=0.01)
    m = gbt.fit(x)
    return M.regression_report(m.transform(x.filter("is_val"))).withColumn("n_trees", F.lit(m.getNumTrees))


@register("tweedie_glm", "K4")
def tweedie_glm(spark, sf):
    x, _ = _tracking_features(spark, sf)
    train, test = x.filter("fold <> 0"), x.filter("fold = 0")
    glm = GeneralizedLinearRegression(featuresCol="features", labelCol="label", family="tweedie",
                                      variancePower=1.5, linkPower=0.0, maxIter=25, regParam=0.01)
    return M.regression_report(glm.fit(train).transform(test))


@register("basket_weight_regression", "K5+G3")
def basket_weight_regression(spark, sf):
    """Sharpe ratio of each basket regressed on its 0/1 asset weights; the
    coefficients are named from the assembler and ranked by magnitude."""
    prices = daily_asset_prices(tracking(Tables(spark, sf)), 365)
    assets = price_assets(prices)
    b = basket_metrics(prices, assets)
    cols = [F.floor(F.col("pid") / 2 ** i) % 2 for i in range(len(assets))]
    x = b.select("sharpe", *[c.cast("double").alias(f"w_{a}") for c, a in zip(cols, assets)])
    asm = VectorAssembler(inputCols=[f"w_{a}" for a in assets], outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol="sharpe", regParam=0.0)
    m = lr.fit(asm.transform(x))
    rows = [(a, float(c)) for a, c in zip(assets, m.coefficients.toArray())]
    coef = spark.createDataFrame(rows, "feature string, coefficient double")
    return coef.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.abs("coefficient")), "feature")))


def _premium(spark, sf):
    x, _ = _tracking_features(spark, sf)
    q80 = quantile_scalars(x, "price_numeric", [0.8])[0]
    x = x.withColumn("premium", (F.col("price_numeric") > q80).cast("double"))
    return x.select("features", "premium", "fold", "order_id", "package_size_id").checkpoint()


@register("logistic_premium", "K6+K11")
def logistic_premium(spark, sf):
    x = _premium(spark, sf)
    train, test = x.filter("fold <> 0"), x.filter("fold = 0")
    lr = LogisticRegression(featuresCol="features", labelCol="premium", regParam=0.01, elasticNetParam=0.5,
                            maxIter=50)
    pred = lr.fit(train).transform(test)
    auc = BinaryClassificationEvaluator(labelCol="premium", rawPredictionCol="rawPrediction").evaluate(pred)
    return pred.agg(F.avg((F.col("prediction") == F.col("premium")).cast("double")).alias("accuracy"),
                    F.lit(auc).alias("auc"), F.count(F.lit(1)).alias("n_test"))


@register("hyperparam_search_cv", "K7+K8")
def hyperparam_search_cv(spark, sf):
    """Seeded random search over regularisation, k-fold CV on hash folds,
    repeated with two fold seeds: mean and std of AUC per setting."""
    x = _premium(spark, sf).filter("fold <> 0").select("features", "premium", "order_id", "package_size_id")
    x = x.cache()
    lr = LogisticRegression(featuresCol="features", labelCol="premium", maxIter=30)
    draws = M.random_param_maps({"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}, 4, seed=7)
    maps = [{lr.regParam: d["regParam"], lr.elasticNetParam: d["elasticNetParam"]} for d in draws]
    ev = BinaryClassificationEvaluator(labelCol="premium")
    results = []
    for rep, seed in enumerate([101, 202]):
        xf = x.withColumn("cv_fold", M.hash_fold("order_id", "package_size_id", k=3, seed=seed))
        cv = CrossValidator(estimator=lr, estimatorParamMaps=maps, evaluator=ev, foldCol="cv_fold", parallelism=4)
        m = cv.fit(xf)
        results += [(rep, d["regParam"], d["elasticNetParam"], float(a)) for d, a in zip(draws, m.avgMetrics)]
    x.unpersist()
    r = spark.createDataFrame(results, "repeat int, regParam double, elasticNetParam double, auc double")
    return r.groupBy("regParam", "elasticNetParam").agg(F.avg("auc").alias("mean_auc"),
                                                        F.stddev_pop("auc").alias("std_auc"))


def _embedding_vectors(spark, sf):
    e = Tables(spark, sf).embeddings
    return e.select("vec_id", "label", array_to_vector(F.transform("embedding", lambda v: v.cast("double")))
                    .alias("features"))


@register("kmeans_sweep", "K15+K16")
def kmeans_sweep(spark, sf):
    x = _embedding_vectors(spark, sf).cache()
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    rows = []
    for k in range(2, 21):
        m = KMeans(k=k, seed=42, featuresCol="features").fit(x)
        rows.append((k, float(m.summary.trainingCost), float(ev.evaluate(m.transform(x)))))
    x.unpersist()
    return spark.createDataFrame(rows, "k int, wcss double, silhouette double")


@register("pca_projection", "K19")
def pca_projection(spark, sf):
    x = _embedding_vectors(spark, sf)
    m = PCA(k=2, inputCol="features", outputCol="pc").fit(x)
    ev = [float(v) for v in m.explainedVariance.toArray()]
    pc = vector_to_array("pc")
    return m.transform(x).select("vec_id", F.get(pc, 0).alias("pc1"), F.get(pc, 1).alias("pc2"),
                                 F.lit(ev[0]).alias("explained_1"), F.lit(ev[1]).alias("explained_2"))


def _monthly_series(spark, sf):
    d = demand(Tables(spark, sf)).withColumn("month", F.trunc("date", "MM"))
    return standard_series(d.groupBy("product_id", "month").agg(F.sum("qtt").alias("qtt")), "product_id", "month", "qtt")


@register("series_kmeans", "K20+F12")
def series_kmeans(spark, sf):
    s = _monthly_series(spark, sf)
    held = s.select("product_id", array_to_vector("series").alias("features")).cache()
    x = held.checkpoint()  # in the partitions of the cached rows; each fit then holds its own vectors unpacked
    held.unpersist()
    ev = ClusteringEvaluator(featuresCol="features")
    rows = []
    for k in range(2, 7):
        m = KMeans(k=k, seed=42, featuresCol="features").fit(x)
        rows.append((k, float(m.summary.trainingCost), float(ev.evaluate(m.transform(x)))))
    best = max(rows, key=lambda r: r[2])[0]
    r = spark.createDataFrame(rows, "k int, inertia double, silhouette double")
    return r.withColumn("chosen", F.col("k") == best)


@register("dtw_medoid_assignment", "K21")
def dtw_medoid_assignment(spark, sf):
    """Each series is compared with m medoid series (m fixed, chosen by seeded hash), never with all others."""
    s = _monthly_series(spark, sf).checkpoint()
    found = s.orderBy(F.xxhash64("product_id", F.lit(5)), "product_id").limit(5).collect()
    medoids = sorted((r["product_id"], list(r["series"])) for r in found)
    return D.assign(s, "product_id", "series", medoids, band=6).select("product_id", "medoid", F.round("distance", 6).alias("distance"))


@register("dtw_clustering", "K21")
def dtw_clustering(spark, sf):
    """Series clustered by dynamic time warping: k-medoids with medoid update."""
    return D.k_medoids(_monthly_series(spark, sf), "product_id", "series", k=3, band=6).select(
        "product_id", "medoid", F.round("distance", 6).alias("distance"))


@register("permutation_importance", "K23")
def permutation_importance(spark, sf):
    """Rise of the held-out RMSE when one column, of all that the model uses, is permuted.  A category's numbers are dealt, not
    its strings: they are one to one and in the same order."""
    x, _ = _tracking_features(spark, sf, M.even_files)
    m = _boosted(x.filter("fold <> 0"), M.onehot_sizes(x, CATS), maxIter=15, maxDepth=5, maxBins=64, seed=42)
    rows = M.permutation_importance(x.filter("fold = 0").select(*TREE_COLS, "label", "order_id", "package_size_id"), TREE_COLS,
                                    ["order_id", "package_size_id"], m.transform)
    rows = [(c, rise) for c, (_, rise) in zip([*CATS, *NUMS], rows)]
    return spark.createDataFrame(rows, "feature string, delta_rmse double")


@register("tree_search_halving", "K7+K8")
def tree_search_halving(spark, sf):
    """Seeded search over tree parameters by successive halving: eight settings on one fold, the better half on two,
    the better half of these on four."""
    x, _ = _tracking_features(spark, sf, M.even_files)
    sizes = M.onehot_sizes(x, CATS)
    draws = M.random_param_maps({"maxDepth": [2, 3, 4, 5], "stepSize": [0.05, 0.1, 0.3], "maxIter": [5, 10], "subsamplingRate": [0.7, 1.0]}, 8, seed=7)
    x = x.select(*TREE_COLS, "label", "fold").cache()
    packed = {}

    def fit(train, draw):
        if packed.get("of") is not train:  # a rung's settings share their rows
            if packed:
                packed["binned"].release()
            packed.update(of=train, binned=B.Binned(train, TREE_COLS[: len(CATS)], sizes, NUMS, "label", seed=42))
        return B.fit(packed["binned"], seed=42, **draw)

    rows = M.successive_halving(x, draws, fit, lambda m, t: M.regression_report(m.transform(t)).first()["rmse"])
    packed["binned"].release()
    x.unpersist()
    best = min(r for r in rows if r[0] == rows[-1][0] and r[3] == min(q[3] for q in rows if q[0] == rows[-1][0]))[1]
    shown = [(rung, *[float(draws[i][k]) for k in ("maxDepth", "stepSize", "maxIter", "subsamplingRate")], used, e, i == best)
             for rung, i, used, e in rows]
    return spark.createDataFrame(shown, "rung int, maxDepth double, stepSize double, maxIter double, subsamplingRate double, folds int, rmse double, chosen boolean")


@register("bisecting_cut_sweep", "K18")
def bisecting_cut_sweep(spark, sf):
    """The bisecting tree over the embeddings cut at 1 to 10 clusters: how many come out and their summed squared error."""
    x = _embedding_vectors(spark, sf).cache()
    rows = []
    for t in range(1, 11):
        pred = BisectingKMeans(k=t, seed=42, featuresCol="features").fit(x).transform(x) if t > 1 else x.withColumn("prediction", F.lit(0))
        n, sse = cluster_sse(pred.select(F.col("prediction").alias("c"), vector_to_array("features").alias("v")), "c", "v").agg(
            F.count(F.lit(1)), F.sum("sse")).first()
        rows.append((t, int(n), float(sse)))
    x.unpersist()
    return spark.createDataFrame(rows, "t int, clusters int, intra_sse double")


@register("label_intra_sse", "K18", sql="""
WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, i, v[i] AS x FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e)),
c AS (SELECT label, i, COUNT(*) AS n, AVG(x) AS m, SUM(x * x) AS q FROM x GROUP BY label, i)
SELECT label, MAX(n) AS n, round(SUM(q - n * m * m), 4) AS sse FROM c GROUP BY label""")
def label_intra_sse(spark, sf):
    """The squared error within given labels that the cut sweep uses for its clusters."""
    e = Tables(spark, sf).embeddings
    return cluster_sse(e, "label", "embedding").select("label", "n", F.round("sse", 4).alias("sse"))


@register("feature_importance", "K23")
def feature_importance(spark, sf):
    """GBT split importance plus mean-ablation importance (RMSE increase when a
    numeric feature is replaced by its training mean)."""
    x, pipe = _tracking_features(spark, sf, M.even_files)
    train, test = x.filter("fold <> 0"), x.filter("fold = 0")
    m = _boosted(train, M.onehot_sizes(x, CATS), maxIter=15, maxDepth=5, maxBins=64, seed=42)
    names = M.feature_names(x)
    base = M.regression_report(m.transform(test)).select("rmse").first()[0]
    rows = []
    means = train.agg(*[F.avg(c) for c in NUMS]).first()
    for c, mean in zip(NUMS, means):
        t2 = pipe.transform(test.drop("features", *[f"{k}_idx" for k in CATS], *[f"{k}_oh" for k in CATS])
                            .withColumn(c, F.lit(float(mean))))
        r = M.regression_report(m.transform(t2)).select("rmse").first()[0]
        rows.append((c, float(r - base)))
    imp = [(n, float(v)) for n, v in zip(names, m.feature_importances)]
    a = spark.createDataFrame(imp, "feature string, split_importance double")
    b = spark.createDataFrame(rows, "feature string, delta_rmse double")
    return a.join(b, "feature", "left")


def _lag_frame(spark, sf, lags):
    fam = family_daily(demand(Tables(spark, sf)))
    w = Window.partitionBy("family_id").orderBy("date")
    back = F.row_number().over(Window.partitionBy("family_id").orderBy(F.desc("date")))
    x = fam.select("family_id", "date", "qtt", back.alias("back"),
                   *[F.lag("qtt", k).over(w).alias(f"lag_{k}") for k in range(1, lags + 1)],
                   F.weekday("date").cast("double").alias("weekday"), F.month("date").cast("double").alias("month"))
    return x.na.drop(subset=[f"lag_{lags}"])


@register("recursive_forecast", "K24+F9")
def recursive_forecast(spark, sf):
    """One-step and 28-step recursive forecasts for every family at once; the
    recursion state is a small per-family array, checkpointed every 7 steps."""
    ensure_checkpoint_dir(spark)
    lags, horizon = 7, 28
    x = _lag_frame(spark, sf, lags)
    feats = [f"lag_{k}" for k in range(1, lags + 1)] + ["weekday", "month"]
    asm = VectorAssembler(inputCols=feats, outputCol="features")
    train = asm.transform(x.filter(F.col("back") > horizon))
    test = asm.transform(x.filter(F.col("back") <= horizon))
    model = GBTRegressor(featuresCol="features", labelCol="qtt", maxIter=20, maxDepth=4, seed=42).fit(train)
    one = model.transform(test).groupBy("family_id").agg(
        F.avg(F.abs(F.col("qtt") - F.greatest(F.lit(0.0), "prediction"))).alias("mae_one_step"),
        F.avg(F.abs(F.col("qtt") - F.col("lag_7"))).alias("mae_naive_7"))
    # Recursion state: last `lags` values (most recent last) and the next date.
    first_test = x.filter(F.col("back") == horizon)
    state = first_test.select("family_id", F.array(*[F.col(f"lag_{k}") for k in range(lags, 0, -1)]).alias("hist"),
                              F.col("date").alias("next_date"))
    preds = None
    for h in range(1, horizon + 1):
        feat = state.select("family_id", "hist", "next_date",
                            *[F.get("hist", lags - k).alias(f"lag_{k}") for k in range(1, lags + 1)],
                            F.weekday("next_date").cast("double").alias("weekday"),
                            F.month("next_date").cast("double").alias("month"))
        p = model.transform(asm.transform(feat)).withColumn("yhat", F.greatest(F.lit(0.0), "prediction"))
        step = p.select("family_id", F.col("next_date").alias("date"), "yhat")
        preds = step if preds is None else preds.unionByName(step)
        state = p.select("family_id", F.slice(F.concat("hist", F.array("yhat")), 2, lags).alias("hist"),
                         F.date_add("next_date", 1).alias("next_date"))
        if h % 7 == 0:
            state, preds = state.checkpoint(), preds.checkpoint()
    actual = x.filter(F.col("back") <= horizon).select("family_id", "date", "qtt")
    rec = preds.join(actual, ["family_id", "date"]).groupBy("family_id").agg(
        F.avg(F.abs(F.col("qtt") - F.col("yhat"))).alias("mae_recursive"))
    return one.join(rec, "family_id")


@register("lookback_window_comparison", "K25")
def lookback_window_comparison(spark, sf):
    """The survey's lookbacks, as many as the series are long enough for: each family's last values up to the lookback, in
    one array from one window, are the features."""
    ensure_checkpoint_dir(spark)
    fam = family_daily(demand(Tables(spark, sf)))
    w = Window.partitionBy("family_id").orderBy("date")
    back = F.row_number().over(Window.partitionBy("family_id").orderBy(F.desc("date")))
    x = fam.select("family_id", "date", "qtt", back.alias("back"), F.collect_list("qtt").over(w.rowsBetween(-LOOKBACKS[-1], -1)).alias("past")).filter(
        F.size("past") == LOOKBACKS[-1]).checkpoint()  # the same rows for every lookback
    rows = []
    for lags in LOOKBACKS:
        seen = F.slice("past", LOOKBACKS[-1] - lags + 1, lags)
        f = x.select("qtt", "back", array_to_vector(F.concat(seen, F.array(
            F.weekday("date").cast("double"), F.month("date").cast("double")))).alias("features"))
        m = GBTRegressor(featuresCol="features", labelCol="qtt", maxIter=10, maxDepth=4, seed=42).fit(f.filter("back > 28"))
        mae = m.transform(f.filter("back <= 28")).agg(F.avg(F.abs(F.col("qtt") - F.col("prediction")))).first()[0]
        rows.append((lags, float(mae) if mae is not None else None))
    return spark.createDataFrame(rows, "lookback int, mae double")


@register("out_of_fold_confusion", "K33+K12")
def out_of_fold_confusion(spark, sf):
    """Each fold predicted by a model fitted on the other folds; every row once."""
    x = _premium(spark, sf).select("features", "premium", "fold").cache()
    parts = []
    for f in range(5):
        lr = LogisticRegression(featuresCol="features", labelCol="premium", regParam=0.01, maxIter=30)
        m = lr.fit(x.filter(F.col("fold") != f))
        parts.append(m.transform(x.filter(F.col("fold") == f)).select("premium", "prediction"))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    res = oof.groupBy("premium", "prediction").agg(F.count(F.lit(1)).alias("n"))
    return res


@register("embedding_svm_report", "K34+K13")
def embedding_svm_report(spark, sf):
    x = _embedding_vectors(spark, sf).withColumn("fold", M.hash_fold("vec_id", k=5))
    train, test = x.filter("fold <> 0"), x.filter("fold = 0")
    ovr = OneVsRest(classifier=LinearSVC(maxIter=50, regParam=0.01), featuresCol="features",
                    labelCol="label_d").fit(train.withColumn("label_d", F.col("label").cast("double")))
    pred = ovr.transform(test).withColumn("predicted", F.col("prediction").cast("int"))
    return class_report(pred, "label", "predicted")
