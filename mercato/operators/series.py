"""Series operators in long form ``(key, time, value)``.

Windows are partitioned by the series key and ordered by time; callers pass
series that are already aggregated to one row per key and step, so each window
partition is bounded by the number of steps.  Per-series statistics that need
no ordering (mean, std, sums) are aggregates joined back, not windows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.calendar import calendar_columns
from mercato.operators.relational import reconcile


def family_daily(demand: DataFrame) -> DataFrame:
    """Daily demand per family on a gap-free calendar (missing days = 0)."""
    daily = demand.groupBy("family_id", "date").agg(F.sum("qtt").alias("qtt"))
    return reconcile(daily, ["family_id"], "date", ["qtt"], fill=0.0)


def _w(key, time):
    return Window.partitionBy(key).orderBy(time)


def add_lags(df: DataFrame, key: str, time: str, v: str, lags: Sequence[int]) -> DataFrame:
    w = _w(key, time)
    return df.select(key, time, v, *[F.lag(v, k).over(w).alias(f"AR_{v}_{k}") for k in lags])


def rolling_columns(key: str, time: str, v: str, p: int, stats=("MA", "MAX", "MIN", "STD")):
    """Leak-free rolling stats: the p+1 values before the current row, null
    until the frame is full (``shift(1).rolling(p + 1)``)."""
    f = _w(key, time).rowsBetween(-(p + 1), -1)
    full = F.count(v).over(f) == p + 1
    agg = {"MA": F.round(F.avg(v).over(f), 6), "MAX": F.max(v).over(f), "MIN": F.min(v).over(f),
           "STD": F.round(F.stddev_samp(v).over(f), 6)}
    return [F.when(full, agg[s]).alias(f"{s}_{v}_{p}") for s in stats]


def add_rolling(df: DataFrame, key: str, time: str, v: str, periods: Sequence[int]) -> DataFrame:
    cols = [c for p in periods for c in rolling_columns(key, time, v, p)]
    return df.select(key, time, v, *cols)


def centred_mean_hourly(events: DataFrame, window: int, min_periods: int) -> DataFrame:
    """Hourly event counts on a regular grid with a centred rolling mean.
    The single ordered window spans the hourly grid (bounded by the time
    range), after the counts were aggregated in parallel."""
    hourly = events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).cast("double").alias("users")).withColumn("_k", F.lit(1))
    grid = reconcile(hourly, ["_k"], "hour", ["users"], step="1 hour", fill=0.0)
    half = window // 2
    f = Window.partitionBy("_k").orderBy("hour").rowsBetween(-half, half)
    mean = F.when(F.count("users").over(f) >= min_periods, F.round(F.avg("users").over(f), 6))
    return grid.select("hour", "users", mean.alias(f"users_mean_{window}_rows"))


def lookback_matrix(df: DataFrame, key: str, time: str, v: str, window: int, horizon: int) -> DataFrame:
    """``create_xy``: x = previous ``window`` values, y = next ``horizon`` values
    (current included); only rows with both frames full."""
    w = _w(key, time)
    x = F.collect_list(v).over(w.rowsBetween(-window, -1))
    y = F.collect_list(v).over(w.rowsBetween(0, horizon - 1))
    out = df.select(key, time, x.alias("x"), y.alias("y"))
    return out.filter((F.size("x") == window) & (F.size("y") == horizon))


def demand_gaps(demand: DataFrame, key: str, time: str, v: str) -> DataFrame:
    """Intervals (in days) between consecutive non-zero demand days per key;
    leading zeros never appear because only non-zero days are kept."""
    pd_ = demand.groupBy(key, time).agg(F.sum(v).alias(v)).filter(F.col(v) != 0)
    gap = F.datediff(F.col(time), F.lag(time).over(_w(key, time)))
    return pd_.withColumn("gap", gap)


def gap_quantiles(gaps: DataFrame, key: str) -> DataFrame:
    g = gaps.filter(F.col("gap").isNotNull())
    return g.groupBy(key).agg(
        F.count("gap").alias("n_gaps"), F.percentile("gap", 0.5).alias("q50"),
        F.percentile("gap", 0.75).alias("q75"), F.percentile("gap", 0.95).alias("q95"),
        F.percentile("gap", 0.99).alias("q99"), F.max("gap").cast("bigint").alias("max_gap"),
        F.round(F.avg("gap"), 6).alias("mean_gap"))


# Syntetos-Boylan demand-class thresholds.
ADI_CUT, CV2_CUT = 1.32, 0.49


def demand_classes(demand: DataFrame, key: str, time: str, v: str) -> DataFrame:
    """ADI (mean interval) and CV^2 of the zero-filled daily series, and the
    demand class.  Moments come from sums over non-zero days plus the calendar
    length, so the zero-filled series is never materialised."""
    n = demand.select((F.datediff(F.max(time), F.min(time)) + 1).cast("double")).scalar()
    gaps = demand_gaps(demand, key, time, v)
    mom = gaps.groupBy(key).agg(F.sum(v).alias("s"), F.sum(F.col(v) * F.col(v)).alias("ss"),
                                F.count(F.lit(1)).alias("nz"),
                                F.avg("gap").alias("adi"))
    mom = mom.filter(F.col("adi").isNotNull())
    var = (F.col("ss") - F.col("s") * F.col("s") / n) / (n - 1)
    mean = F.col("s") / n
    cv2 = var / (mean * mean)
    adi = F.col("adi")
    cls = (F.when((adi < ADI_CUT) & (cv2 < CV2_CUT), "Smooth demand")
           .when((adi >= ADI_CUT) & (cv2 < CV2_CUT), "Intermittent demand")
           .when(adi < ADI_CUT, "Erratic demand").otherwise("Lumpy demand"))
    return mom.select(key, F.round(adi, 6).alias("adi"), F.round(cv2, 6).alias("cv2"),
                      F.round(n / (n - F.col("nz")), 6).alias("adi_zero"), cls.alias("demand_class"))


def seasonal_naive_mae(df: DataFrame, key: str, time: str, v: str, lags: Sequence[int], test: int) -> DataFrame:
    w = _w(key, time)
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(time)))
    x = df.select(key, v, back.alias("back"), *[F.lag(v, k).over(w).alias(f"p{k}") for k in lags])
    x = x.filter(F.col("back") <= test)
    return x.groupBy(key).agg(*[F.round(F.avg(F.abs(F.col(v) - F.col(f"p{k}"))), 6).alias(f"mae_lag_{k}")
                                for k in lags])


def time_split(df: DataFrame, key: str, time: str, test: int) -> DataFrame:
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(time)))
    return df.withColumn("split", F.when(back <= test, "test").otherwise("train"))


def snapshot_changes(tr: DataFrame) -> DataFrame:
    """Price change between consecutive daily snapshots of a product.  The
    day's last snapshot is chosen by an aggregate, then the lag runs over one
    row per product-day."""
    d = tr.groupBy("product_id", "date").agg(
        F.max_by("price_numeric", F.struct("order_id", "package_size_id")).alias("price"))
    prev = F.lag("price").over(_w("product_id", "date"))
    return d.select("product_id", "date", "price", prev.alias("prev_price"),
                    F.round(F.col("price") - prev, 2).alias("change"))


def znorm(df: DataFrame, key: str, v: str) -> DataFrame:
    """(x - mean) / population std per series; a constant series maps to 0."""
    s = df.groupBy(key).agg(F.avg(v).alias("_mu"), F.stddev_pop(v).alias("_sd"))
    z = F.when(F.col("_sd") == 0, F.lit(0.0)).otherwise((F.col(v) - F.col("_mu")) / F.col("_sd"))
    return df.join(s, key).withColumn("z", z).drop("_mu", "_sd")


def standard_series(df: DataFrame, key: str, month: str, v: str) -> DataFrame:
    """(key, series): each key's monthly values, 0 where there are none, over the months of all keys, standardised; a constant
    series maps to 0.  The array is filled in the row, so the calendar is never joined.  Null keys are left out."""
    from mercato.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(key, v, (F.year(month) * 12 + F.month(month)).alias("_m")).checkpoint()
    first, last = df.agg(F.min("_m"), F.max("_m")).first()
    if first is None:
        return df.select(key, F.array().cast("array<double>").alias("series")).filter("false")
    seen = F.when(F.col("_m").isNotNull(), F.struct(F.col("_m").alias("m"), F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias("v")))
    x = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(seen)).alias("_h"))
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    before = lambda i: F.when(i == 0, F.lit(first - 1)).otherwise(F.get("_h", i - 1)["m"])
    filled = F.flatten(F.transform("_h", lambda r, i: F.concat(zeros(r["m"] - before(i) - 1), F.array(r["v"]))))
    end = F.coalesce(F.get("_h", F.size("_h") - 1)["m"], F.lit(first - 1))
    x = x.select(key, F.concat(filled, zeros(F.lit(last) - end)).alias("_s"))
    total = lambda f: F.aggregate("_s", F.lit(0.0), lambda a, y: a + f(y))
    n = float(last - first + 1)
    x = x.withColumn("_mu", total(lambda y: y) / n)
    x = x.withColumn("_sd", F.when(F.array_min("_s") == F.array_max("_s"), 0.0).otherwise(
        F.sqrt(total(lambda y: (y - F.col("_mu")) * (y - F.col("_mu"))) / n)))
    return x.select(key, F.transform("_s", lambda y: F.when(F.col("_sd") == 0, F.lit(0.0)).otherwise(
        (y - F.col("_mu")) / F.col("_sd"))).alias("series"))


def feature_matrix(df: DataFrame, key: str, time: str, v: str) -> DataFrame:
    w = _w(key, time)
    cols = [F.lag(v, 1).over(w).alias(f"AR_{v}_1"), F.lag(v, 7).over(w).alias(f"AR_{v}_7"),
            *rolling_columns(key, time, v, 6, ("MA", "MAX"))]
    cal_cols = [c for c in calendar_columns(time)]
    keep = {"month", "weekday", "is_weekend"}
    return df.select(key, time, v, *cols, *[c for c in cal_cols if _alias(c) in keep])


def _alias(c) -> str:
    s = c._jc.toString()
    return s.rsplit(" AS ", 1)[-1].strip("`")


def acf(df: DataFrame, key: str, time: str, v: str, max_lag: int) -> DataFrame:
    """Autocorrelation r_k = sum (x_t - mu)(x_{t-k} - mu) / sum (x_t - mu)^2."""
    return _acf_sums(df, key, time, v, max_lag).select(key, "k", F.round("r", 6).alias("acf"))


def _acf_sums(df: DataFrame, key: str, time: str, v: str, max_lag: int) -> DataFrame:
    mu = df.groupBy(key).agg(F.avg(v).alias("_mu"))
    d = df.join(mu, key).withColumn("dx", F.col(v) - F.col("_mu"))
    w = _w(key, time)
    lagged = d.select(key, "dx", *[F.lag("dx", k).over(w).alias(f"l{k}") for k in range(1, max_lag + 1)])
    sums = lagged.groupBy(key).agg(F.sum(F.col("dx") * F.col("dx")).alias("den"),
                                   *[F.sum(F.col("dx") * F.col(f"l{k}")).alias(f"n{k}")
                                     for k in range(1, max_lag + 1)])
    entries = F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.col(f"n{k}").alias("num"))
                        for k in range(1, max_lag + 1)])
    return sums.select(key, "den", F.inline(entries)).select(key, "k", F.when(F.col("den") > 0, F.col("num") / F.col("den")).alias("r"))


def pacf(df: DataFrame, key: str, time: str, v: str, max_lag: int) -> DataFrame:
    """Partial autocorrelations to ``max_lag`` by the Durbin-Levinson recursion over each series' autocorrelations."""
    r = _acf_sums(df, key, time, v, max_lag).groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "r"))), lambda x: x["r"]).alias("_r"))
    zero = F.lit(0.0)

    def step(state: Column, k: Column) -> Column:
        # phi are the coefficients of order k - 1; the last of order k is the partial autocorrelation
        phi, out = state["phi"], state["out"]
        back = F.zip_with(phi, F.reverse(F.slice("_r", 1, k - 1)), lambda a, b: a * b)
        fore = F.zip_with(phi, F.slice("_r", 1, k - 1), lambda a, b: a * b)
        total = lambda x: F.aggregate(x, zero, lambda acc, y: acc + y)
        num, den = F.get("_r", k - 1) - total(back), 1.0 - total(fore)
        return F.get(F.transform(F.array(F.when(F.abs(den) > 1e-12, num / den)), lambda a: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - a * y), F.array(a)).alias("phi"),
            F.concat(out, F.array(a)).alias("out"))), F.lit(0))

    none = F.array().cast("array<double>")
    done = F.aggregate(F.sequence(F.lit(1), F.lit(max_lag)), F.struct(none.alias("phi"), none.alias("out")), step, lambda x: x["out"])
    return r.select(key, F.posexplode(done).alias("i", "pacf")).select(key, (F.col("i") + 1).cast("bigint").alias("k"), F.round("pacf", 6).alias("pacf"))


def change_points(df: DataFrame, key: str, time: str, v: str, half: int, weight: float = 3.0) -> DataFrame:
    """Where the sliding gain is the largest within ``half`` steps each way and exceeds the penalty
    ``weight`` * var(x) * ln(n) of its series."""
    gains = change_gain(df, key, time, v, half)
    pen = df.groupBy(key).agg((F.lit(weight) * F.var_samp(v) * F.ln(F.count(F.lit(1)).cast("double"))).alias("penalty"))
    top = F.max("gain").over(_w(key, time).rowsBetween(-half, half))
    return gains.withColumn("_top", top).join(pen, key).filter((F.col("gain") == F.col("_top")) & (F.col("gain") > F.col("penalty"))).select(
        key, time, "gain", F.round("penalty", 4).alias("penalty"))


def segment_breaks(df: DataFrame, key: str, time: str, v: str, weight: float = 3.0, least: int = 5) -> DataFrame:
    """Breakpoints of the best segmentation of each series: squared error around segment means plus a penalty
    ``weight`` * noise * ln(n) per segment, the noise from the median absolute step.  Exact dynamic programme
    with pruning of starts that can no longer win; one calendar-bounded series per group."""
    kind = df.schema[key].dataType.simpleString()
    when = df.schema[time].dataType.simpleString()

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time)
        x = pdf[v].to_numpy(dtype=float)
        n = len(x)
        noise = (np.median(np.abs(np.diff(x))) / 0.9539) ** 2 if n > 1 else 0.0
        pen = weight * max(noise, 1e-12) * np.log(max(n, 2))
        s, q = np.concatenate(([0.0], np.cumsum(x))), np.concatenate(([0.0], np.cumsum(x * x)))
        best, last = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        best[0], starts = -pen, np.array([0])
        for t in range(least, n + 1):
            if t >= 2 * least:
                starts = np.append(starts, t - least)
            cost = q[t] - q[starts] - (s[t] - s[starts]) ** 2 / (t - starts)
            total = best[starts] + cost + pen
            i = int(total.argmin())
            best[t], last[t] = total[i], starts[i]
            starts = starts[best[starts] + cost <= best[t]]
        breaks, t = [], n
        while n >= least and last[t] > 0:
            t = last[t]
            breaks.append(t)
        rows = pdf.iloc[sorted(breaks)]
        means = [0, *sorted(breaks), n]
        out = pd.DataFrame({key: rows[key], time: rows[time]})
        out["mean_before"] = [float(x[a:b].mean()) for a, b in zip(means, means[1:-1])]
        out["mean_after"] = [float(x[a:b].mean()) for a, b in zip(means[1:-1], means[2:])]
        return out

    return df.select(key, time, v).groupBy(key).applyInPandas(cut, f"{key} {kind}, {time} {when}, mean_before double, mean_after double")


def change_gain(df: DataFrame, key: str, time: str, v: str, half: int) -> DataFrame:
    """Sliding-window L2 change-point gain: cost(whole) - cost(left) - cost(right),
    with cost = sum x^2 - (sum x)^2 / n, from window sums only."""
    w = _w(key, time)
    left, right = w.rowsBetween(-half, -1), w.rowsBetween(0, half - 1)
    x2 = F.col(v) * F.col(v)
    x = df.select(key, time, F.sum(v).over(left).alias("sl"), F.sum(x2).over(left).alias("ql"),
                  F.count(F.lit(1)).over(left).alias("nl"), F.sum(v).over(right).alias("sr"),
                  F.sum(x2).over(right).alias("qr"), F.count(F.lit(1)).over(right).alias("nr"))
    sl, ql, sr, qr = (F.col(c) for c in ("sl", "ql", "sr", "qr"))
    gain = (((ql + qr) - (sl + sr) * (sl + sr) / float(2 * half)) - (ql - sl * sl / float(half))
            - (qr - sr * sr / float(half)))
    return x.filter((F.col("nl") == half) & (F.col("nr") == half)).select(key, time, F.round(gain, 4).alias("gain"))


# Asymptotic Dickey-Fuller critical values (constant, no trend).
ADF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def adf_by_series(df: DataFrame, key: str, time: str, v: str, lags: int = 1) -> DataFrame:
    """Augmented Dickey-Fuller t statistic per series, one OLS per group in
    ``applyInPandas`` (a group is one calendar-bounded series)."""
    key_type = dict(df.dtypes)[key]
    schema = T.StructType([T.StructField(key, T.StringType() if key_type == "string" else T.LongType()),
                           T.StructField("adf_stat", T.DoubleType()), T.StructField("n_obs", T.LongType()),
                           T.StructField("stationary_5pct", T.BooleanType())])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(time)[v].to_numpy(dtype=float)
        dy = np.diff(y)
        rows = len(dy) - lags
        if rows <= lags + 3:
            return pd.DataFrame({key: [pdf[key].iloc[0]], "adf_stat": [np.nan], "n_obs": [0],
                                 "stationary_5pct": [False]})
        target = dy[lags:]
        cols = [np.ones(rows), y[lags:-1]] + [dy[lags - j:-j] for j in range(1, lags + 1)]
        X = np.column_stack(cols)
        beta, *_ = np.linalg.lstsq(X, target, rcond=None)
        resid = target - X @ beta
        sigma2 = resid @ resid / (rows - X.shape[1])
        cov = sigma2 * np.linalg.pinv(X.T @ X)
        stat = float(beta[1] / np.sqrt(cov[1, 1]))
        return pd.DataFrame({key: [pdf[key].iloc[0]], "adf_stat": [stat], "n_obs": [rows],
                             "stationary_5pct": [stat < ADF_CRITICAL["5%"]]})

    return df.select(key, time, v).groupBy(key).applyInPandas(fit, schema)
