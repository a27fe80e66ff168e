"""URL helpers: query parameters as rows, search-API parameter mapping,
URL encoding and path-id splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def query_string(url: Column) -> Column:
    return F.regexp_extract(url, r"\?([^#]*)", 1)


def query_pairs(df: DataFrame, key: str, url: str) -> DataFrame:
    """One row per non-blank query pair: (key, pos, param, value), decoded."""
    parts = F.split(query_string(F.col(url)), "&")
    x = df.select(key, F.posexplode(parts).alias("pos", "kv"))
    kv = F.split(F.col("kv"), "=", 2)
    x = x.select(key, "pos", F.try_url_decode(F.get(kv, 0)).alias("param"),
                 F.try_url_decode(F.get(kv, 1)).alias("value"))
    return x.filter((F.col("param") != "") & F.col("value").isNotNull() & (F.col("value") != ""))


def params_joined(pairs: DataFrame, key: str, sep: str = ",") -> DataFrame:
    """Repeated keys joined in URL order; one row per (key, param)."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return pairs.groupBy(key, "param").agg(
        F.array_join(F.transform(ordered, lambda s: s["value"]), sep).alias("value"))


# Search-URL query key -> API parameter, and the joiner used.
SEARCH_PARAM_MAP = [
    ("search_text", "search_text", "+"),
    ("catalog_ids[]", "catalog_ids", ","),
    ("color_id[]", "color_ids", ","),
    ("brand_ids[]", "brand_ids", ","),
    ("size_id[]", "size_ids", ","),
    ("material_id[]", "material_ids", ","),
    ("status[]", "status_ids", ","),
    ("country_id[]", "country_ids", ","),
    ("city_id[]", "city_ids", ","),
    ("disposal[]", "is_for_swap", ","),
    ("currency", "currency", ","),
    ("price_to", "price_to", ","),
    ("price_from", "price_from", ","),
    ("order", "order", ","),
]


def search_api_params(df: DataFrame, key: str, url: str, page: int = 1, per_page: int = 20) -> DataFrame:
    """Search URL -> API parameters (long form), empty ones dropped, plus paging."""
    spark = df.sparkSession
    mapping = spark.createDataFrame(SEARCH_PARAM_MAP, "param string, api_param string, sep string")
    pairs = query_pairs(df, key, url).join(F.broadcast(mapping), "param")  # fixed 14-row table
    pairs = pairs.withColumn("value", F.when(F.col("api_param") == "is_for_swap", F.lit("1"))
                             .otherwise(F.col("value")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    joined = pairs.groupBy(key, "api_param", "sep").agg(ordered.alias("vals")).select(
        key, F.col("api_param").alias("param"),
        F.when(F.col("sep") == "+", F.array_join(F.transform("vals", lambda s: s["value"]), "+"))
        .otherwise(F.array_join(F.transform("vals", lambda s: s["value"]), ",")).alias("value"))
    paging = df.select(key, F.inline(F.array(
        F.struct(F.lit("page").alias("param"), F.lit(str(page)).alias("value")),
        F.struct(F.lit("per_page").alias("param"), F.lit(str(per_page)).alias("value")))))
    return joined.unionByName(paging)


def encode_params(params: Column) -> Column:
    """map<string,string> -> ``k=v&k2=v2`` with URL-encoded values, keys sorted."""
    entries = F.array_sort(F.map_entries(params))
    return F.array_join(F.transform(entries, lambda e: F.concat(F.url_encode(e["key"]), F.lit("="),
                                                                 F.url_encode(e["value"]))), "&")


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]+(/[^?#]*)?", 1)


def split_id(c: Column, sep: str = "/") -> Column:
    return F.split(c, sep)
