"""Model evaluation as aggregates: regression/classification summaries,
ROC points, per-class reports, min-max scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.ranges import quantile_scalars
from mercato.operators.ranking import rank_table


def regression_summary(p: DataFrame, y: str, yhat: str) -> DataFrame:
    e = F.col(y) - F.col(yhat)
    median = quantile_scalars(p.select(F.abs(e).alias("_e")), "_e", [0.5])[0]
    return p.agg(
        F.round(F.avg(e * e), 2).alias("mse"), F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"),
        F.round(F.avg(F.abs(e)), 4).alias("mae"), F.round(F.any_value(median), 4).alias("medae"),
        F.round(1 - F.sum(e * e) / (F.var_pop(y) * F.count(F.lit(1))), 6).alias("r2"),
        F.round(F.avg(F.abs(e) / F.abs(F.col(y))), 6).alias("mape"),
        F.round(1 - F.var_pop(e) / F.var_pop(y), 6).alias("explained_variance"),
        F.round(F.max(F.abs(e)), 4).alias("max_error"))


def auc_rank_sum(d: DataFrame, y: str, score: str):
    """Exact AUC from tie-averaged ranks (Mann-Whitney), as a scalar column."""
    r = rank_table(d, score, [("pos", F.col(y) == 1)])
    s = r.agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("rp"), F.sum("pos").alias("P"),
              F.sum("c").alias("n"))
    P = F.col("P").cast("double")
    Nn = (F.col("n") - F.col("P")).cast("double")
    return s.select(((F.col("rp") - P * (P + 1) / 2.0) / (P * Nn)).alias("auc")).scalar()


def binary_summary(d: DataFrame, y: str, pred: str, score: str) -> DataFrame:
    yy, pp = F.col(y), F.col(pred)
    auc = auc_rank_sum(d, y, score)
    return d.agg(
        F.round(F.avg(F.when(yy == pp, 1.0).otherwise(0.0)), 6).alias("accuracy"),
        F.round(F.sum(F.when((yy == 1) & (pp == 1), 1).otherwise(0)) / F.sum(F.when(yy == 1, 1.0).otherwise(0.0)), 6)
        .alias("recall"),
        F.round(F.sum(F.when((yy == 0) & (pp == 0), 1).otherwise(0)) / F.sum(F.when(yy == 0, 1.0).otherwise(0.0)), 6)
        .alias("specificity"),
        F.round(F.sum(F.when((yy == 1) & (pp == 1), 1).otherwise(0)) / F.sum(F.when(pp == 1, 1.0).otherwise(0.0)), 6)
        .alias("precision"),
        F.round(auc, 6).alias("auc"))


def roc_curve(d: DataFrame, y: str, score: str) -> DataFrame:
    """(threshold, tpr, fpr) at every distinct score, from per-value counts."""
    r = rank_table(d, score, [("pos", F.col(y) == 1), ("neg", F.col(y) != 1)])
    tot = r.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    return r.select(F.col(score).alias("threshold"),
                    F.round((P - F.col("below_pos")) / P, 6).alias("tpr"),
                    F.round((N - F.col("below_neg")) / N, 6).alias("fpr"))


def class_report(d: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision / recall / F1 / support per class, then macro and weighted rows."""
    s1 = d.groupBy(label).agg(F.count(F.lit(1)).alias("support"),
                              F.count_if(F.col(label) == F.col(pred)).alias("tp"))
    s2 = d.groupBy(F.col(pred).alias(label)).agg(F.count(F.lit(1)).alias("npred"))
    m = s1.join(s2, label, "left").fillna(0, ["npred"])
    prec = F.when(F.col("npred") == 0, 0.0).otherwise(F.col("tp") / F.col("npred"))
    rec = F.when(F.col("support") == 0, 0.0).otherwise(F.col("tp") / F.col("support"))
    p = m.select(F.col(label).cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                 "support")
    f = p.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
    cols = ["precision", "recall", "f1"]
    per = f.select("class", *[F.round(c, 6).alias(c) for c in cols], "support")
    macro = f.agg(F.lit("macro avg").alias("class"), *[F.round(F.avg(c), 6).alias(c) for c in cols],
                  F.sum("support").cast("bigint").alias("support"))
    weighted = f.agg(F.lit("weighted avg").alias("class"),
                     *[F.round(F.sum(F.col(c) * F.col("support")) / F.sum("support"), 6).alias(c) for c in cols],
                     F.sum("support").cast("bigint").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def minmax_scale(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """(x - min) / (max - min) per column; a constant column maps to 0
    (``ml.MinMaxScaler`` would give 0.5)."""
    b = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols], *[F.max(c).alias(f"{c}__hi") for c in cols])
    out = []
    for c in cols:
        lo, hi = b.select(f"{c}__lo").scalar(), b.select(f"{c}__hi").scalar()
        out.append(F.when(hi == lo, F.lit(0.0)).otherwise(F.round((F.col(c) - lo) / (hi - lo), digits)).alias(c))
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *out)
