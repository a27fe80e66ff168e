"""Time-series plans.

Every window here runs over a series that was aggregated first (one row per
key per day or hour), so a window partition is bounded by the calendar length,
not by how many raw rows a hot key has.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import series as S
from mercato.plans.registry import register
from mercato.sources.tables import Tables, demand, tracking

FAMILY_DAILY_SQL = """WITH daily AS (SELECT family_id, date, SUM(qtt) AS qtt FROM demand GROUP BY family_id, date),
bounds AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM daily),
fam AS (
  SELECT s.family_id, s.date, COALESCE(d.qtt, 0.0) AS qtt
  FROM (SELECT f.family_id, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT DISTINCT family_id FROM daily) f, bounds b) s
  LEFT JOIN daily d ON s.family_id = d.family_id AND s.date = d.date)"""

W_SQL = "(PARTITION BY family_id ORDER BY date)"


def family_daily(spark, sf):
    return S.family_daily(demand(Tables(spark, sf)))


def _frame_sql(p):
    return f"(PARTITION BY family_id ORDER BY date ROWS BETWEEN {p + 1} PRECEDING AND 1 PRECEDING)"


@register("autoregressive_lags", "F1", sql=FAMILY_DAILY_SQL + f"""
SELECT family_id, date, qtt, lag(qtt, 1) OVER {W_SQL} AS AR_qtt_1, lag(qtt, 7) OVER {W_SQL} AS AR_qtt_7,
       lag(qtt, 28) OVER {W_SQL} AS AR_qtt_28 FROM fam""")
def autoregressive_lags(spark, sf):
    return S.add_lags(family_daily(spark, sf), "family_id", "date", "qtt", [1, 7, 28])


_roll_sql = ",\n".join(
    f"CASE WHEN COUNT(qtt) OVER {_frame_sql(p)} = {p + 1} THEN round(AVG(qtt) OVER {_frame_sql(p)}, 6) END AS MA_qtt_{p},\n"
    f"CASE WHEN COUNT(qtt) OVER {_frame_sql(p)} = {p + 1} THEN MAX(qtt) OVER {_frame_sql(p)} END AS MAX_qtt_{p},\n"
    f"CASE WHEN COUNT(qtt) OVER {_frame_sql(p)} = {p + 1} THEN MIN(qtt) OVER {_frame_sql(p)} END AS MIN_qtt_{p},\n"
    f"CASE WHEN COUNT(qtt) OVER {_frame_sql(p)} = {p + 1} THEN round(stddev_samp(qtt) OVER {_frame_sql(p)}, 6) END AS STD_qtt_{p}"
    for p in (2, 6))


@register("leak_free_rolling", "F2+F3", sql=FAMILY_DAILY_SQL + f"""
SELECT family_id, date, qtt,
{_roll_sql}
FROM fam""")
def leak_free_rolling(spark, sf):
    return S.add_rolling(family_daily(spark, sf), "family_id", "date", "qtt", [2, 6])


@register("centred_rolling_mean", "F4", sql="""
WITH hourly AS (SELECT date_trunc('hour', ts) AS hour, CAST(COUNT(*) AS DOUBLE) AS users FROM events GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT MIN(hour) FROM hourly), (SELECT MAX(hour) FROM hourly),
                                       INTERVAL 1 HOUR)) AS hour),
g AS (SELECT grid.hour, COALESCE(h.users, 0.0) AS users FROM grid LEFT JOIN hourly h ON grid.hour = h.hour)
SELECT hour, users,
  CASE WHEN COUNT(users) OVER w >= 180 THEN round(AVG(users) OVER w, 6) END AS users_mean_365_rows
FROM g WINDOW w AS (ORDER BY hour ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)""")
def centred_rolling_mean(spark, sf):
    return S.centred_mean_hourly(Tables(spark, sf).events, 365, 180)


@register("keep_last_per_product", "F6", sql="""
SELECT product_id, date, order_id, package_size_id, price_numeric FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC, order_id DESC,
                               package_size_id DESC) AS rn FROM tracking) WHERE rn = 1""")
def keep_last_per_product(spark, sf):
    from mercato.operators.relational import latest_per_key
    tr = tracking(Tables(spark, sf)).select("product_id", "date", "order_id", "package_size_id",
                                            "price_numeric")
    return latest_per_key(tr, ["product_id"], ["date", "order_id", "package_size_id"])


@register("lookback_matrix", "F7", sql=FAMILY_DAILY_SQL + """
SELECT family_id, date, x, y FROM (
  SELECT family_id, date,
    array_to_string(list(CAST(qtt AS VARCHAR)) OVER (PARTITION BY family_id ORDER BY date
                    ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), ',') AS x,
    array_to_string(list(CAST(qtt AS VARCHAR)) OVER (PARTITION BY family_id ORDER BY date
                    ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), ',') AS y,
    COUNT(*) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS nx,
    COUNT(*) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS ny
  FROM fam) WHERE nx = 7 AND ny = 3""")
def lookback_matrix(spark, sf):
    m = S.lookback_matrix(family_daily(spark, sf), "family_id", "date", "qtt", 7, 3)
    as_text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    return m.select("family_id", "date", as_text(F.col("x")).alias("x"), as_text(F.col("y")).alias("y"))


_DEMAND_GAPS_SQL = """WITH pd AS (SELECT product_id, date, SUM(qtt) AS qtt FROM demand GROUP BY product_id, date
            HAVING SUM(qtt) <> 0),
g AS (SELECT product_id, date, date - lag(date) OVER (PARTITION BY product_id ORDER BY date) AS gap FROM pd)"""


@register("inter_demand_gaps", "F8", sql=_DEMAND_GAPS_SQL + """
SELECT product_id, COUNT(gap) AS n_gaps, quantile_cont(gap, 0.5) AS q50, quantile_cont(gap, 0.75) AS q75,
       quantile_cont(gap, 0.95) AS q95, quantile_cont(gap, 0.99) AS q99, MAX(gap) AS max_gap,
       round(AVG(gap), 6) AS mean_gap
FROM g WHERE gap IS NOT NULL GROUP BY product_id""")
def inter_demand_gaps(spark, sf):
    return S.gap_quantiles(S.demand_gaps(demand(Tables(spark, sf)), "product_id", "date", "qtt"), "product_id")


@register("demand_classes", "F8+H19", sql=_DEMAND_GAPS_SQL + """,
span AS (SELECT CAST(MAX(date) - MIN(date) + 1 AS DOUBLE) AS n FROM demand),
mom AS (SELECT product_id, SUM(qtt) AS s, SUM(qtt * qtt) AS ss FROM pd GROUP BY product_id),
adi AS (SELECT product_id, AVG(gap) AS adi FROM g WHERE gap IS NOT NULL GROUP BY product_id),
st AS (SELECT m.product_id, a.adi, (m.ss - m.s * m.s / span.n) / (span.n - 1) AS var, m.s / span.n AS mean,
              span.n / (span.n - (SELECT COUNT(*) FROM pd WHERE pd.product_id = m.product_id)) AS adi_zero
       FROM mom m JOIN adi a ON m.product_id = a.product_id, span)
SELECT product_id, round(adi, 6) AS adi, round(var / (mean * mean), 6) AS cv2, round(adi_zero, 6) AS adi_zero,
  CASE WHEN adi < 1.32 AND var / (mean * mean) < 0.49 THEN 'Smooth demand'
       WHEN adi >= 1.32 AND var / (mean * mean) < 0.49 THEN 'Intermittent demand'
       WHEN adi < 1.32 THEN 'Erratic demand' ELSE 'Lumpy demand' END AS demand_class
FROM st""")
def demand_classes(spark, sf):
    return S.demand_classes(demand(Tables(spark, sf)), "product_id", "date", "qtt")


@register("demand_classes_all", "H19", sql="""
WITH day AS (SELECT date, SUM(qtt) AS qtt FROM demand GROUP BY date),
pd AS (SELECT 'daily' AS k, date, qtt FROM day
       UNION ALL SELECT 'weekdays', date, 1.0 FROM day WHERE isodow(date) <= 5
       UNION ALL SELECT 'peaks', date, CASE WHEN day(date) = 1 THEN 50 * qtt ELSE qtt END FROM day
       UNION ALL SELECT 'monthly', date, qtt FROM day WHERE day(date) = 1),
g AS (SELECT *, date - lag(date) OVER (PARTITION BY k ORDER BY date) AS gap FROM pd WHERE qtt <> 0),
span AS (SELECT CAST(MAX(date) - MIN(date) + 1 AS DOUBLE) AS n FROM pd),
st AS (SELECT k, AVG(gap) AS adi, SUM(qtt) / ANY_VALUE(n) AS mean,
              (SUM(qtt * qtt) - SUM(qtt) * SUM(qtt) / ANY_VALUE(n)) / (ANY_VALUE(n) - 1) AS var FROM g, span GROUP BY k)
SELECT k, round(adi, 6) AS adi, round(var / (mean * mean), 6) AS cv2,
  CASE WHEN adi < 1.32 AND var / (mean * mean) < 0.49 THEN 'Smooth demand'
       WHEN adi >= 1.32 AND var / (mean * mean) < 0.49 THEN 'Intermittent demand'
       WHEN adi < 1.32 THEN 'Erratic demand' ELSE 'Lumpy demand' END AS demand_class FROM st""")
def demand_classes_all(spark, sf):
    """Series of every class, derived from the daily demand: as it is, one unit on weekdays, with peaks, monthly."""
    day = demand(Tables(spark, sf)).groupBy("date").agg(F.sum("qtt").alias("qtt"))
    first = F.dayofmonth("date") == 1
    kinds = [("daily", F.col("qtt")), ("weekdays", F.when(F.weekday("date") < 5, 1.0)), ("peaks", F.when(first, 50 * F.col("qtt")).otherwise(F.col("qtt"))),
             ("monthly", F.when(first, F.col("qtt")))]
    rows = day.select("date", F.inline(F.array(*[F.struct(F.lit(n).alias("k"), q.cast("double").alias("qtt")) for n, q in kinds]))).filter("qtt is not null")
    return S.demand_classes(rows, "k", "date", "qtt").drop("adi_zero")


@register("seasonal_naive_mae", "F9+F10", sql=FAMILY_DAILY_SQL + """,
x AS (SELECT family_id, date, qtt,
        lag(qtt, 1) OVER w AS p1, lag(qtt, 7) OVER w AS p7, lag(qtt, 28) OVER w AS p28,
        lag(qtt, 336) OVER w AS p336,
        row_number() OVER (PARTITION BY family_id ORDER BY date DESC) AS back
      FROM fam WINDOW w AS (PARTITION BY family_id ORDER BY date))
SELECT family_id, round(AVG(abs(qtt - p1)), 6) AS mae_lag_1, round(AVG(abs(qtt - p7)), 6) AS mae_lag_7,
       round(AVG(abs(qtt - p28)), 6) AS mae_lag_28, round(AVG(abs(qtt - p336)), 6) AS mae_lag_336
FROM x WHERE back <= 28 GROUP BY family_id""")
def seasonal_naive_mae(spark, sf):
    return S.seasonal_naive_mae(family_daily(spark, sf), "family_id", "date", "qtt", [1, 7, 28, 336], 28)


@register("time_ordered_split", "F10", sql=FAMILY_DAILY_SQL + """
SELECT family_id, CASE WHEN back <= 28 THEN 'test' ELSE 'train' END AS split, COUNT(*) AS n,
       MIN(date) AS first_date, MAX(date) AS last_date
FROM (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY date DESC) AS back FROM fam)
GROUP BY ALL""")
def time_ordered_split(spark, sf):
    x = S.time_split(family_daily(spark, sf), "family_id", "date", 28)
    return x.groupBy("family_id", "split").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"),
                                               F.max("date").alias("last_date"))


@register("snapshot_price_change", "F11", sql="""
WITH d AS (SELECT product_id, date, arg_max(price_numeric, (order_id, package_size_id)) AS price
           FROM tracking GROUP BY product_id, date)
SELECT product_id, date, price, lag(price) OVER w AS prev_price, round(price - lag(price) OVER w, 2) AS change
FROM d WINDOW w AS (PARTITION BY product_id ORDER BY date)""")
def snapshot_price_change(spark, sf):
    return S.snapshot_changes(tracking(Tables(spark, sf)))


@register("sold_after_silence", "F11", sql="""
SELECT product_id, MAX(date) AS last_seen, COUNT(*) AS n_snapshots FROM tracking GROUP BY product_id
HAVING MAX(date) < (SELECT MAX(date) FROM tracking) - INTERVAL 365 DAY""")
def sold_after_silence(spark, sf):
    tr = tracking(Tables(spark, sf))
    cutoff = F.date_sub(tr.select(F.max("date")).scalar(), 365)
    return (tr.groupBy("product_id").agg(F.max("date").alias("last_seen"), F.count(F.lit(1)).alias("n_snapshots"))
            .filter(F.col("last_seen") < cutoff))


@register("series_znorm", "F12", sql=FAMILY_DAILY_SQL + """,
s AS (SELECT family_id, AVG(qtt) AS mu, stddev_pop(qtt) AS sd FROM fam GROUP BY family_id)
SELECT f.family_id, f.date, CASE WHEN s.sd = 0 THEN 0.0 ELSE round((f.qtt - s.mu) / s.sd, 6) END AS z
FROM fam f JOIN s ON f.family_id = s.family_id""")
def series_znorm(spark, sf):
    z = S.znorm(family_daily(spark, sf), "family_id", "qtt")
    return z.select("family_id", "date", F.round("z", 6).alias("z"))


@register("calendar_features", "H14", sql=FAMILY_DAILY_SQL + """
SELECT date, SUM(qtt) AS qtt, CAST(weekofyear(date) AS INTEGER) AS week, CAST(month(date) AS INTEGER) AS month,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) - 1 AS INTEGER) AS weekday, CAST(dayofyear(date) AS INTEGER) AS dayofyear,
  CASE WHEN dayofyear(date) BETWEEN 270 AND 355 THEN 1 ELSE 0 END AS is_christmas,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM fam GROUP BY date""")
def calendar_features(spark, sf):
    from mercato.functions.calendar import calendar_columns
    daily = family_daily(spark, sf).groupBy("date").agg(F.sum("qtt").alias("qtt"))
    return daily.select("date", "qtt", *calendar_columns("date"))


@register("forecast_feature_matrix", "K30", sql=FAMILY_DAILY_SQL + f"""
SELECT family_id, date, qtt, lag(qtt, 1) OVER {W_SQL} AS AR_qtt_1, lag(qtt, 7) OVER {W_SQL} AS AR_qtt_7,
  CASE WHEN COUNT(qtt) OVER {_frame_sql(6)} = 7 THEN round(AVG(qtt) OVER {_frame_sql(6)}, 6) END AS MA_qtt_6,
  CASE WHEN COUNT(qtt) OVER {_frame_sql(6)} = 7 THEN MAX(qtt) OVER {_frame_sql(6)} END AS MAX_qtt_6,
  CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) - 1 AS INTEGER) AS weekday,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM fam""")
def forecast_feature_matrix(spark, sf):
    x = S.feature_matrix(family_daily(spark, sf), "family_id", "date", "qtt")
    return x


@register("autocorrelation", "J11", sql=FAMILY_DAILY_SQL + """,
s AS (SELECT family_id, AVG(qtt) AS mu FROM fam GROUP BY family_id),
d AS (SELECT f.family_id, f.date, f.qtt - s.mu AS dx FROM fam f JOIN s ON f.family_id = s.family_id),
l AS (SELECT family_id, dx, """ + ", ".join(
    f"lag(dx, {k}) OVER (PARTITION BY family_id ORDER BY date) AS l{k}" for k in range(1, 8)) + """ FROM d)
SELECT family_id, k, round(num / den, 6) AS acf FROM (
  SELECT family_id, SUM(dx * dx) AS den, """ + ", ".join(f"SUM(dx * l{k}) AS n{k}" for k in range(1, 8)) + """
  FROM l GROUP BY family_id) a,
  LATERAL (SELECT unnest(range(1, 8)) AS k,
                  unnest([""" + ", ".join(f"a.n{k}" for k in range(1, 8)) + """]) AS num)""")
def autocorrelation(spark, sf):
    return S.acf(family_daily(spark, sf), "family_id", "date", "qtt", 7)


@register("change_point_gain", "J12", sql=FAMILY_DAILY_SQL + """,
w AS (SELECT family_id, date,
        SUM(qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS sl,
        SUM(qtt * qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS ql,
        COUNT(*) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS nl,
        SUM(qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS sr,
        SUM(qtt * qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS qr,
        COUNT(*) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS nr
      FROM fam)
SELECT family_id, date,
  round(((ql + qr) - (sl + sr) * (sl + sr) / 60.0) - (ql - sl * sl / 30.0) - (qr - sr * sr / 30.0), 4) AS gain
FROM w WHERE nl = 30 AND nr = 30""")
def change_point_gain(spark, sf):
    return S.change_gain(family_daily(spark, sf), "family_id", "date", "qtt", 30)


@register("partial_autocorrelation", "J11", sql="WITH RECURSIVE " + FAMILY_DAILY_SQL.strip()[5:] + """,
s AS (SELECT family_id, AVG(qtt) AS mu FROM fam GROUP BY family_id),
d AS (SELECT f.family_id, f.date, f.qtt - s.mu AS dx FROM fam f JOIN s ON f.family_id = s.family_id),
l AS (SELECT family_id, dx, """ + ", ".join(
    f"lag(dx, {k}) OVER (PARTITION BY family_id ORDER BY date) AS l{k}" for k in range(1, 8)) + """ FROM d),
r AS (SELECT family_id, [""" + ", ".join(f"SUM(dx * l{k}) / SUM(dx * dx)" for k in range(1, 8)) + """] AS r FROM l GROUP BY family_id),
levinson AS (
  SELECT family_id, r, 1 AS k, [r[1]] AS phi, r[1] AS a FROM r
  UNION ALL
  SELECT family_id, r, k + 1, list_transform(phi, lambda x, i: x - na * phi[k + 1 - i]) || [na], na
  FROM (SELECT *, (r[k + 1] - list_sum(list_transform(phi, lambda x, i: x * r[k + 1 - i])))
                  / (1 - list_sum(list_transform(phi, lambda x, i: x * r[i]))) AS na FROM levinson WHERE k < 7))
SELECT family_id, CAST(k AS BIGINT) AS k, round(a, 6) AS pacf FROM levinson""")
def partial_autocorrelation(spark, sf):
    return S.pacf(family_daily(spark, sf), "family_id", "date", "qtt", 7)


@register("change_points", "J12", sql=FAMILY_DAILY_SQL + """,
w AS (SELECT family_id, date,
        SUM(qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS sl,
        SUM(qtt * qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS ql,
        COUNT(*) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS nl,
        SUM(qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS sr,
        SUM(qtt * qtt) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS qr,
        COUNT(*) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS nr
      FROM fam),
g AS (SELECT family_id, date,
  round(((ql + qr) - (sl + sr) * (sl + sr) / 60.0) - (ql - sl * sl / 30.0) - (qr - sr * sr / 30.0), 4) AS gain
  FROM w WHERE nl = 30 AND nr = 30),
t AS (SELECT *, MAX(gain) OVER (PARTITION BY family_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING) AS top FROM g),
p AS (SELECT family_id, 1.0 * var_samp(qtt) * ln(CAST(COUNT(*) AS DOUBLE)) AS penalty FROM fam GROUP BY family_id)
SELECT t.family_id, t.date, t.gain, round(p.penalty, 4) AS penalty FROM t JOIN p USING (family_id)
WHERE gain = top AND gain > penalty""")
def change_points(spark, sf):
    """Peaks of the sliding gain over a penalty."""
    return S.change_points(family_daily(spark, sf), "family_id", "date", "qtt", 30, weight=1.0)


@register("segment_breaks", "J12")
def segment_breaks(spark, sf):
    """Breakpoints of the penalised segmentation of every family's series (tested on planted breaks)."""
    return S.segment_breaks(family_daily(spark, sf), "family_id", "date", "qtt")


@register("adf_stationarity", "J10")
def adf_stationarity(spark, sf):
    return S.adf_by_series(family_daily(spark, sf), "family_id", "date", "qtt", lags=1)


@register("weekly_product_series_stats", "E22+F12", sql="""
WITH weekly AS (SELECT product_id, date_trunc('week', date) AS week, SUM(qtt) AS qtt FROM demand GROUP BY ALL)
SELECT product_id, COUNT(*) AS n_weeks,
       round(CASE WHEN stddev_pop(qtt) = 0 THEN 0.0 ELSE (MAX(qtt) - AVG(qtt)) / stddev_pop(qtt) END, 6) AS max_z
FROM weekly GROUP BY product_id""")
def weekly_product_series_stats(spark, sf):
    """Per product: weekly demand series z-normed, summarised."""
    d = demand(Tables(spark, sf))
    weekly = d.groupBy("product_id", F.date_trunc("week", "date").alias("week")).agg(F.sum("qtt").alias("qtt"))
    z = S.znorm(weekly, "product_id", "qtt")
    return z.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_weeks"), F.round(F.max("z"), 6).alias("max_z"))
