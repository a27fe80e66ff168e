"""Basket (portfolio) statistics over catalogue price series.

Assets are catalogues; their daily median price is the return series.  The
k x k covariance is one aggregate over the date-pivoted series (k(k+1)/2
``covar_samp`` expressions), so no pair rows are emitted per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.ranges import quantiles


#: Assets of a basket study (it has 2**k - 1 baskets), and of a covariance matrix.
MOST_ASSETS = 16
MOST_COVARIANCE_ASSETS = 100


def daily_asset_prices(tr: DataFrame, days: int, asset: str = "catalog_id") -> DataFrame:
    recent = tr.filter(F.col("date") >= F.date_sub(tr.select(F.max("date")).scalar(), days))
    return quantiles(recent, "price_numeric", [0.5], ["date", asset]).select(
        "date", F.col(asset).alias("asset"), F.get("_q", F.lit(0)).alias("price"))


def price_assets(prices: DataFrame, most: int = MOST_ASSETS) -> list[str]:
    """All assets that have prices, in order; more than ``most`` are an error."""
    found = [r[0] for r in prices.select("asset").filter("asset is not null").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} assets")
    return sorted(found)


def asset_covariance(prices: DataFrame, assets: Sequence[str]) -> DataFrame:
    """Long (asset_a, asset_b, cov) sample covariance over dates both assets priced."""
    wide = prices.groupBy("date").pivot("asset", list(assets)).agg(F.first("price"))
    pairs = [(a, b) for i, a in enumerate(assets) for b in assets[i:]]
    row = wide.agg(*[F.covar_samp(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"{i}") for i, (a, b) in
                     enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("asset_a"), F.lit(b).alias("asset_b"), F.col(f"{i}").alias("cov")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("asset_a"), F.lit(a).alias("asset_b"),
                                    F.col(f"{i}").alias("cov")))
    return row.select(F.inline(F.array(*entries)))


def asset_stats(prices: DataFrame) -> DataFrame:
    return quantiles(prices, "price", [0.5, 0.05], ["asset"]).select(
        "asset", F.get("_q", F.lit(0)).alias("med"), F.get("_q", F.lit(1)).alias("q05"))


def basket_metrics(prices: DataFrame, assets: Sequence[str]) -> DataFrame:
    """Every non-empty 0/1 basket over the k assets (basket id bit i = asset i):
    revenue = w.median, volatility = sqrt(w' S w), VaR = w.(median - q05),
    Sharpe = revenue / volatility, plus the equal-weight benchmark ratio.
    The k asset statistics and the k x k covariance ride along as arrays on
    one row; baskets are a range that Spark partitions, each joined to that row.
    The assets are a parameter of at most ``MOST_ASSETS``; prices of other assets are left out."""
    assets = sorted(assets)
    k = len(assets)
    if not 1 <= k <= MOST_ASSETS:
        raise ValueError(f"1 to {MOST_ASSETS} assets, not {k}: there are 2**k - 1 baskets")
    # index i below is the i-th requested asset, so no other may take part
    prices = prices.filter(F.col("asset").isin(assets))
    st = asset_stats(prices).agg(F.sort_array(F.collect_list(F.struct("asset", "med", "q05"))).alias("st"))
    cov = asset_covariance(prices, assets)
    cm = cov.select(F.sort_array(F.collect_list(F.struct("asset_a", "asset_b", "cov")))).scalar()
    base = prices.sparkSession.range(1, 2 ** k).toDF("pid").crossJoin(F.broadcast(st.withColumn("cm", cm)))
    idx = F.sequence(F.lit(0), F.lit(k - 1))
    w = lambda i: F.floor(F.col("pid") / F.pow(F.lit(2.0), i)) % 2  # bit i of the basket id
    med = lambda i: F.get(F.col("st"), i)["med"]
    q05 = lambda i: F.get(F.col("st"), i)["q05"]
    cv = lambda i, j: F.get(F.col("cm"), i * k + j)["cov"]

    def sum_over(f):
        return F.aggregate(F.transform(idx, f), F.lit(0.0), lambda acc, x: acc + x)

    rev = sum_over(lambda i: w(i) * med(i))
    var = sum_over(lambda i: sum_over(lambda j: w(i) * w(j) * cv(i, j)))
    var_naive = sum_over(lambda i: sum_over(lambda j: cv(i, j)))
    rev_naive = sum_over(lambda i: med(i))
    value_at_risk = sum_over(lambda i: w(i) * (med(i) - q05(i)))
    sharpe = rev / F.sqrt(var)
    naive = rev_naive / F.sqrt(var_naive)
    return base.select(F.col("pid").cast("bigint").alias("pid"), F.round(rev, 4).alias("revenue"),
                       F.round(F.sqrt(var), 4).alias("volatility"), F.round(value_at_risk, 4).alias("value_at_risk"),
                       F.round(sharpe, 6).alias("sharpe"),
                       sum_over(lambda i: w(i)).cast("bigint").alias("n_assets"),
                       F.round(sharpe / naive, 6).alias("relative_sharpe"))
