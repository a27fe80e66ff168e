"""HTML pages, URLs and JSON payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.functions.urls import params_joined, query_pairs, search_api_params, url_path
from mercato.operators.html import listing_features, page_text, parse_listings
from mercato.plans.registry import register
from mercato.sources.tables import Tables


@register("html_listings", "I1+I2+M5")
def html_listings(spark, sf):
    """Every <article> of every page parsed into typed listing rows."""
    pages = Tables(spark, sf).pages
    return listing_features(parse_listings(pages, classes=None))


@register("page_title_text", "I4", sql=r"""
WITH t AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
                  trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text
           FROM pages)
SELECT page_id, title, length(text) AS text_len, sha256(text) AS text_hash FROM t""")
def page_title_text(spark, sf):
    t = page_text(Tables(spark, sf).pages)
    return t.select("page_id", "title", F.length("text").alias("text_len"), F.sha2("text", 256).alias("text_hash"))


@register("url_query_params", "H9", sql=r"""
WITH q AS (SELECT page_id, string_split(regexp_extract(url, '\?([^#]*)', 1), '&') AS parts FROM pages),
kv AS (SELECT page_id, unnest(parts) AS kv, unnest(range(len(parts))) AS pos FROM q),
p AS (SELECT page_id, pos, url_decode(split_part(kv, '=', 1)) AS param,
             CASE WHEN strpos(kv, '=') > 0 THEN url_decode(substr(kv, strpos(kv, '=') + 1)) END AS value FROM kv)
SELECT page_id, param, string_agg(value, ',' ORDER BY pos) AS value
FROM p WHERE param <> '' AND value IS NOT NULL AND value <> '' GROUP BY page_id, param""")
def url_query_params(spark, sf):
    pairs = query_pairs(Tables(spark, sf).pages, "page_id", "url")
    return params_joined(pairs, "page_id")


@register("search_api_params", "H9+A1")
def search_api_params_q(spark, sf):
    return search_api_params(Tables(spark, sf).pages, "page_id", "url")


@register("search_params_mapped", "H9", sql="""
WITH p AS (SELECT p_partkey AS page_id, p_size, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)
SELECT page_id, 'catalog_ids' AS param, p_size || ',' || (p_size + 1) AS value FROM p
UNION ALL SELECT page_id, 'search_text', a || '+' || b FROM p
UNION ALL SELECT page_id, 'status_ids', CAST(page_id % 5 AS VARCHAR) FROM p
UNION ALL SELECT page_id, 'order', 'newest first' FROM p
UNION ALL SELECT page_id, 'is_for_swap', '1' FROM p WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 'page', '1' FROM p
UNION ALL SELECT page_id, 'per_page', '20' FROM p""")
def search_params_mapped(spark, sf):
    """Search urls made from the products, with repeated, encoded, empty and unknown parameters."""
    p = Tables(spark, sf).part
    size = F.col("p_size")
    url = F.concat(F.lit("https://shop.example/catalog?catalog_ids[]="), size.cast("string"), F.lit("&utm=x&catalog_ids[]="), (size + 1).cast("string"),
                   F.lit("&search_text="), F.substring_index("p_name", " ", 1), F.lit("&search_text="), F.element_at(F.split("p_name", " "), 2),
                   F.lit("&brand_ids[]=&order=newest%20first&status%5B%5D="), (F.col("p_partkey") % 5).cast("string"),
                   F.when(F.col("p_partkey") % 2 == 0, "&disposal[]=7#top").otherwise(""))
    return search_api_params(p.select(F.col("p_partkey").alias("page_id"), url.alias("url")), "page_id", "url")


@register("url_path_segments", "H11", sql=r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)?', 1) AS path FROM pages)
SELECT page_id, path, string_split(path, '/')[2] AS section, string_split(path, '/')[3] AS item,
       CAST(len(string_split(path, '/')) AS INTEGER) AS n_parts FROM p""")
def url_path_segments(spark, sf):
    p = Tables(spark, sf).pages.select("page_id", url_path(F.col("url")).alias("path"))
    parts = F.split("path", "/")
    return p.select("page_id", "path", F.get(parts, 1).alias("section"), F.get(parts, 2).alias("item"),
                    F.size(parts).alias("n_parts"))


@register("json_props_extract", "H12+A9", sql="""
SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, COUNT(*) AS n, round(SUM(value), 4) AS value
FROM events GROUP BY 1""")
def json_props_extract(spark, sf):
    e = Tables(spark, sf).events
    return (e.groupBy(F.get_json_object("props", "$.k").cast("int").alias("k"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value")))


@register("page_script_payload", "A9", sql=r"""
SELECT page_id, regexp_extract(html, '<script>(.*?)</script>', 1) AS script,
       json_extract_string(NULLIF(regexp_extract(html, '<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), ''),
                           '$.buildId') AS build_id
FROM pages""")
def page_script_payload(spark, sf):
    p = Tables(spark, sf).pages
    nd = F.regexp_extract("html", r'<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    return p.select("page_id", F.regexp_extract("html", r"<script>(.*?)</script>", 1).alias("script"),
                    F.get_json_object(F.nullif(nd, F.lit("")), "$.buildId").alias("build_id"))
