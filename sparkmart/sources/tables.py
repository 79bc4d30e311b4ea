"""The driver-generated parquet tables and the retail fact derived from them.

Everything here is lazy: the returned DataFrames are plans over the parquet
files, so column pruning and filter pushdown reach the scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the tables as temp views (for ``spark.sql`` users)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def transaction_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail transaction fact (FIXTURES §3) mapped from the generated tables.

    InvoiceNo=o_orderkey, StockCode=p_brand, Description=p_name,
    Quantity=±l_quantity (negative for returned lines), InvoiceDate=o_orderdate,
    UnitPrice=l_extendedprice/l_quantity, CustomerID=o_custkey, Country=n_name,
    total_spend=±l_extendedprice as decimal(18,2).

    Join order: the order-level dimension (orders ⋈ customer ⋈ nation) is built
    first, then the large line table joins it on the order key and the part
    dimension on the part key.  No side is broadcast by hint: Spark decides from
    the sizes it knows, and otherwise runs a sort-merge join whose skewed
    partitions AQE splits.  A line of quantity 0 has no unit price.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")

    order_dim = (od.join(cu, od.o_custkey == cu.c_custkey)
                   .join(na, F.col("c_nationkey") == na.n_nationkey)
                   .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    joined = (li.join(order_dim, li.l_orderkey == order_dim.o_orderkey)
                .join(pa, li.l_partkey == pa.p_partkey))
    returned = F.col("l_returnflag") == "R"
    return joined.select(
        F.col("o_orderkey").alias("InvoiceNo"),
        F.col("p_brand").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.try_divide("l_extendedprice", "l_quantity").alias("UnitPrice"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.when(returned, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
         .cast("decimal(18,2)").alias("total_spend"),
    )


# The same mapping as SQL text, used by the DuckDB oracles (and runnable by
# spark.sql over registered views).
FACT_SQL = """
SELECT o.o_orderkey AS InvoiceNo, p.p_brand AS StockCode, p.p_name AS Description,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INT) AS Quantity,
       o.o_orderdate AS InvoiceDate,
       l.l_extendedprice / l.l_quantity AS UnitPrice,
       o.o_custkey AS CustomerID, n.n_name AS Country,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_extendedprice ELSE l.l_extendedprice END
            AS DECIMAL(18,2)) AS total_spend
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
"""


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
