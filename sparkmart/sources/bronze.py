"""A raw, all-text invoice table derived from the generated tables, and the
ingestion config that types it.  It gives the ingestion operators real input
whose size grows with the data: every fact line becomes one raw line with
padded codes, ``M/d/yyyy H:mm`` dates and float-style customer ids.  Fixed
shares of the lines are dirty: credit notes (``C`` before the number), discount
lines, missing descriptions and customers, fractional or unreadable quantities,
unreadable dates, and zero or unreadable prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.tables import table

RAW_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
               "UnitPrice", "CustomerID", "Country")


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_retailprice")
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
           .join(cu, F.col("o_custkey") == cu.c_custkey)
           .join(na, F.col("c_nationkey") == na.n_nationkey)
           .join(pa, li.l_partkey == pa.p_partkey))
    order, credit = F.col("o_orderkey"), F.col("l_returnflag") == "R"
    qty = F.when(credit, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").cast("string")
    discount = credit & (order % 31 == 0)
    line = F.col("l_partkey") + order
    return j.select(
        F.concat(F.when(order % 4 == 0, "  ").otherwise(""), F.when(credit, "C").otherwise(""), order.cast("string"), F.lit(" "))
         .alias("InvoiceNo"),
        F.when(discount, "D").otherwise(F.concat(F.col("p_brand"), F.lit("  "))).alias("StockCode"),
        F.when(discount, "Discount").when(line % 23 != 0, F.concat(F.lit("  "), F.col("p_name"))).alias("Description"),
        F.when(line % 41 == 0, "n/a").when(line % 43 == 0, F.concat(qty, F.lit(".5"))).otherwise(qty).alias("Quantity"),
        F.when(order % 37 == 0, "unknown").otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm")).alias("InvoiceDate"),
        F.when(order % 29 == 0, "0.0").when(order % 53 == 0, "free")
         .otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("UnitPrice"),
        F.when(order % 19 == 0, "").when(order % 17 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


RAW_SQL = """
SELECT CASE WHEN o.o_orderkey % 4 = 0 THEN '  ' ELSE '' END || CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END
         || CAST(o.o_orderkey AS VARCHAR) || ' ' AS InvoiceNo,
       CASE WHEN l.l_returnflag = 'R' AND o.o_orderkey % 31 = 0 THEN 'D' ELSE p.p_brand || '  ' END AS StockCode,
       CASE WHEN l.l_returnflag = 'R' AND o.o_orderkey % 31 = 0 THEN 'Discount'
            WHEN (l.l_partkey + o.o_orderkey) % 23 <> 0 THEN '  ' || p.p_name END AS Description,
       CASE WHEN (l.l_partkey + o.o_orderkey) % 41 = 0 THEN 'n/a'
            ELSE CAST(CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INTEGER) AS VARCHAR)
                 || CASE WHEN (l.l_partkey + o.o_orderkey) % 43 = 0 THEN '.5' ELSE '' END END AS Quantity,
       CASE WHEN o.o_orderkey % 37 = 0 THEN 'unknown' ELSE strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M') END AS InvoiceDate,
       CASE WHEN o.o_orderkey % 29 = 0 THEN '0.0' WHEN o.o_orderkey % 53 = 0 THEN 'free'
            ELSE CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS UnitPrice,
       CASE WHEN o.o_orderkey % 19 = 0 THEN ''
            WHEN o.o_orderkey % 17 <> 0 THEN CAST(o.o_custkey AS VARCHAR) || '.0' END AS CustomerID,
       n.n_name AS Country
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
"""


def _column(target: str, source: str, kind: str, nullable: bool = False, **rules) -> dict:
    return {"target_column": target, "source_column": source, "column_type": kind, "nullable": nullable,
            "transformation_rules": [{name: arg} for name, arg in rules.items()]}


_SOLD = "M/d/yyyy H:mm"

# What the raw table above needs, in its column order: credit notes and padded codes as text, two
# readings of the price, and the sale's time as date, timestamp and month text.
INVOICE_CONFIG = {
    "table_name": "retail_lines",
    "columns": [
        _column("document", "InvoiceNo", "str", trim=["trim"]),
        _column("item_code", "StockCode", "str", trim=["rtrim"]),
        _column("item_text", "Description", "str", nullable=True, trim=["ltrim"]),
        _column("units", "Quantity", "long"),
        _column("sold_on", "InvoiceDate", "date", format_datetime={"source_format": _SOLD}),
        _column("list_price", "UnitPrice", "decimal(12,3)", round=1),
        _column("price_value", "UnitPrice", "double", nullable=True),
        _column("buyer", "CustomerID", "int", nullable=True),
        _column("market", "Country", "str"),
    ],
    "new_columns": [
        _column("sold_at", "InvoiceDate", "timestamp", format_datetime={"source_format": _SOLD}),
        _column("sold_month", "InvoiceDate", "str", nullable=True,
                format_datetime={"source_format": _SOLD, "target_format": "yyyy/MM"}),
    ],
    "primary_key": ["document", "item_code", "units", "list_price"],
    "partition_column": ["sold_on", "market"],
}
