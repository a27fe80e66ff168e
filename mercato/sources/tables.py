"""Driver tables with explicit schemas, and the two bound views.

``tracking`` (one row per product snapshot) and ``demand`` (one row per order
line with its order, product and client) are plain DataFrame joins, so Catalyst
prunes the columns a query does not touch and pushes filters into the scans.
Dimension joins are left to the planner: AQE turns a join into a broadcast only
after it has measured the smaller side against
``spark.sql.autoBroadcastJoinThreshold``; above it the join stays sort-merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                        ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                    ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                      ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                      ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

TABLE_NAMES = tuple(SCHEMAS)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem`` is a parquet scan."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def load(self, name: str) -> DataFrame:
        return (self.spark.read.format(self.fmt).schema(SCHEMAS[name])
                .load(f"{self.root}/{name}.{self.fmt}"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return self.load(name)
        raise AttributeError(name)

    def register_views(self) -> None:
        """Expose every table plus ``tracking``/``demand`` to ``spark.sql``."""
        for n in SCHEMAS:
            self.load(n).createOrReplaceTempView(n)
        tracking(self).createOrReplaceTempView("tracking")
        demand(self).createOrReplaceTempView("demand")


def read_jdbc_query(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
                    lower: int | None = None, upper: int | None = None, num_partitions: int = 1,
                    **options) -> DataFrame:
    """Pushed-query scan of a relational source (``read_sql(query)``).

    With ``partition_column`` the scan is split into ``num_partitions`` range
    reads so a large table is not pulled through one connection.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", query)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


# ----------------------------------------------------------------------------------------------
# Bound views

def tracking(t: Tables, since=None) -> DataFrame:
    """Marketplace snapshot rows: lineitem joined with part; with ``since``, a date, only rows from that day on (a
    condition on the stored timestamp, which reaches the scan)."""
    li, p = t.lineitem, t.part
    if since is not None:
        li = li.filter(F.col("l_shipdate") >= F.lit(str(since)).cast("timestamp"))
    return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("p_type").alias("catalog_id"),
        F.col("p_brand").alias("brand_title"),
        F.col("p_size").cast("string").alias("size_title"),
        F.col("l_returnflag").alias("status"),
        F.col("l_extendedprice").alias("price_numeric"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_linenumber").alias("package_size_id"),
        F.col("l_quantity").alias("view_count"),
        F.col("l_linenumber").alias("favourite_count"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


TRACKING_SQL = """tracking AS (
  SELECT l.l_partkey AS product_id, l.l_suppkey AS user_id, p.p_type AS catalog_id,
         p.p_brand AS brand_title, CAST(p.p_size AS VARCHAR) AS size_title,
         l.l_returnflag AS status, l.l_extendedprice AS price_numeric,
         CAST(l.l_shipdate AS DATE) AS date, l.l_linenumber AS package_size_id,
         l.l_quantity AS view_count, l.l_linenumber AS favourite_count,
         l.l_orderkey AS order_id, l.l_discount AS discount, l.l_tax AS tax
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def demand(t: Tables) -> DataFrame:
    """Order lines with order date, product family/parent and client type (left joins)."""
    li, o, p, c = t.lineitem, t.orders, t.part, t.customer
    return (li.join(o, li.l_orderkey == o.o_orderkey, "left")
            .join(p, li.l_partkey == p.p_partkey, "left")
            .join(c, o.o_custkey == c.c_custkey, "left")
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("product_id"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("ettdeb"),
                    F.col("l_extendedprice").alias("edebito"),
                    F.col("l_discount").alias("desconto"),
                    F.col("l_quantity").alias("qtt"),
                    F.col("o_orderdate").alias("dataobra"),
                    F.to_date("o_orderdate").alias("date"),
                    F.col("o_custkey").alias("client_id"),
                    F.col("p_type").alias("family_id"),
                    F.col("p_brand").alias("nome_top_parent"),
                    F.col("c_mktsegment").alias("tipo")))


DEMAND_SQL = """demand AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id,
         l.l_extendedprice * (1 - l.l_discount) AS ettdeb, l.l_extendedprice AS edebito,
         l.l_discount AS desconto, l.l_quantity AS qtt, o.o_orderdate AS dataobra,
         CAST(o.o_orderdate AS DATE) AS date, o.o_custkey AS client_id,
         p.p_type AS family_id, p.p_brand AS nome_top_parent, c.c_mktsegment AS tipo
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


def as_of(df: DataFrame, col: str = "date") -> Column:
    """``CURRENT_DATE`` stand-in: the latest date in the data, as a scalar subquery."""
    return df.select(F.max(col)).scalar()
