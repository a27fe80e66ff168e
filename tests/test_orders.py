"""Order sums by product where keys of orders, products and clients repeat, are null or have no row."""

import tempfile

from mercato.plans import aggregation
from mercato.sources.tables import SCHEMAS, Tables, demand


def test_orders_by_product_counts_rows_like_demand(spark, monkeypatch):
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="orders-")

    def table(name, cols, rows):
        df = spark.createDataFrame(rows, cols)
        df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in SCHEMAS[name]]).write.parquet(f"{root}/{name}.parquet")

    table("lineitem", "l_orderkey long, l_partkey long, l_quantity double",
          [(1, 1, 2.0), (1, 1, 3.0), (2, 1, 4.0), (3, 2, 5.0), (None, 2, 6.0), (4, None, 7.0), (9, 3, None), (9, 3, None), (2, 2, 1.0)])
    table("orders", "o_orderkey long, o_custkey long", [(1, 1), (1, 2), (2, 2), (3, None), (None, 1)])
    table("customer", "c_custkey long, c_name string", [(1, "a"), (2, "b"), (2, "c"), (None, "d")])
    table("part", "p_partkey long, p_name string", [(1, "a"), (2, "b"), (2, "c"), (None, "d")])
    monkeypatch.setattr(aggregation, "ORDER_LINES", 2)  # more parts than shuffles have
    want = demand(Tables(spark, root)).groupBy("product_id").agg(F.countDistinct("order_id").alias("n_orders"), F.sum("qtt").alias("qtt"))
    got = aggregation.orders_by_product(spark, root)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 4
