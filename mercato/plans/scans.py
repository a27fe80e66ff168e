"""Scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.plans.registry import register
from mercato.sources.tables import Tables


@register("scan_pushed_query", "A1+C6", sql="""
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_discount >= 0.05 AND l_quantity < 10""")
def scan_pushed_query(spark, sf):
    """The ``read_sql(query)`` shape: projection and predicates reach the scan
    (``PushedFilters`` / ``ReadSchema`` in the plan)."""
    li = Tables(spark, sf).lineitem
    return (li.filter((F.col("l_discount") >= 0.05) & (F.col("l_quantity") < 10))
            .select("l_orderkey", "l_partkey", "l_extendedprice"))


@register("sql_view_query", "A1", sql="""
SELECT status, COUNT(*) AS n, round(SUM(price_numeric), 2) AS value FROM tracking
WHERE date >= DATE '2000-01-01' GROUP BY status""")
def sql_view_query(spark, sf):
    """The same engine through ``spark.sql`` over registered views."""
    Tables(spark, sf).register_views()
    return spark.sql("""SELECT status, COUNT(*) AS n, round(SUM(price_numeric), 2) AS value FROM tracking
                        WHERE date >= DATE '2000-01-01' GROUP BY status""")


@register("unfetched_parts", "A12", sql="""
SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem
  WHERE l_shipdate >= (SELECT MAX(l_shipdate) FROM lineitem) - INTERVAL 90 DAY)""")
def unfetched_parts(spark, sf):
    """Work-list of products with no recent snapshot (anti join, not a re-fetch of everything)."""
    t = Tables(spark, sf)
    li = t.lineitem
    recent = li.filter(F.col("l_shipdate") >= li.select(F.max("l_shipdate")).scalar() - F.expr("INTERVAL 90 DAYS"))
    part = t.part
    return part.join(recent, part.p_partkey == recent.l_partkey, "left_anti").select("p_partkey", "p_brand")


@register("catalog_introspection", "A11")
def catalog_introspection(spark, sf):
    """Schema, table, column, type, nullability and ordinal of every driver
    table and bound view registered from ``sf``."""
    from mercato.sources.files import catalog_columns
    Tables(spark, sf).register_views()
    return catalog_columns(spark)
