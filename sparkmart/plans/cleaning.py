"""Clean & load queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.functions.columns import money
from sparkmart.operators import clean, profile, series
from sparkmart.plans.registry import register
from sparkmart.plans.timeseries import _DAILY_CTE
from sparkmart.sources.bronze import RAW_SQL, raw_invoices

_CLEAN_CTES = f"""
WITH raw AS ({RAW_SQL}),
typed AS (
  SELECT CAST(InvoiceNo AS VARCHAR) AS InvoiceNo, upper(StockCode) AS StockCode,
         coalesce(Description, 'No Description') AS Description,
         CAST(trunc(TRY_CAST(Quantity AS DECIMAL(38,10))) AS INTEGER) AS Quantity,
         CAST(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS TIMESTAMP) AS InvoiceDate,
         TRY_CAST(UnitPrice AS DECIMAL(18,4)) AS price,
         coalesce(CAST(trunc(TRY_CAST(CustomerID AS DOUBLE)) AS BIGINT), 0) AS CustomerID,
         Country
  FROM raw),
counts AS (SELECT StockCode, Description, count(*) AS n FROM typed GROUP BY StockCode, Description),
modes AS (
  SELECT StockCode, Description FROM (
    SELECT StockCode, Description,
           row_number() OVER (PARTITION BY StockCode ORDER BY n DESC, Description) AS rk
    FROM counts) WHERE rk = 1)
"""

_CLEAN_SQL = _CLEAN_CTES + """
SELECT t.InvoiceNo, t.StockCode, m.Description, t.Quantity, t.InvoiceDate,
       CAST(t.price AS DOUBLE) AS UnitPrice, t.CustomerID, t.Country,
       CAST(CAST(t.Quantity AS DECIMAL(10,0)) * t.price AS DOUBLE) AS total_spend
FROM typed t LEFT JOIN modes m ON t.StockCode = m.StockCode
"""

_MODE_SQL = _CLEAN_CTES + "SELECT StockCode, Description FROM modes"


@register("clean_transactions", oracle=_CLEAN_SQL,
          covers=("N1", "P11", "P14", "X2", "A7", "J3"))
def clean_transactions(spark, sf_dir):
    """Raw invoice text → clean fact with description repair."""
    return clean.clean_transactions(raw_invoices(spark, sf_dir))


@register("description_mode", oracle=_MODE_SQL, covers=("A7",))
def description_mode(spark, sf_dir):
    """Most frequent description per (upper-cased) stock code."""
    raw = raw_invoices(spark, sf_dir)
    return clean.description_mode(raw.select(F.upper("StockCode").alias("StockCode"),
                                             F.coalesce("Description", F.lit(clean.NO_DESCRIPTION)).alias("Description")))


# The same profiles over the cleaned dirty table, where every class and many nulls occur.
_FACT_CTES = _CLEAN_CTES + """,
fact AS (SELECT t.InvoiceNo, t.StockCode, m.Description, t.Quantity, t.InvoiceDate, CAST(t.price AS DOUBLE) AS UnitPrice,
                t.CustomerID, t.Country, CAST(CAST(t.Quantity AS DECIMAL(10,0)) * t.price AS DECIMAL(18,2)) AS total_spend
         FROM typed t LEFT JOIN modes m ON t.StockCode = m.StockCode)"""
_FACT_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country", "total_spend")


@register("dirty_null_profile", covers=("A10", "F2"), oracle=_FACT_CTES + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM fact" for c in _FACT_COLUMNS))
def dirty_null_profile(spark, sf_dir):
    """Nulls that cleaning leaves: unreadable quantities, dates and prices."""
    return profile.null_profile(clean.clean_transactions(raw_invoices(spark, sf_dir)))


@register("dirty_line_classes", covers=("F10", "F4"), oracle=_FACT_CTES + """
SELECT CASE WHEN Quantity < 0 AND Description = 'Discount' THEN 'discount' WHEN Quantity < 0 AND UnitPrice = 0 THEN 'free'
            WHEN Quantity < 0 AND UnitPrice > 0 THEN 'refund' WHEN Quantity < 0 THEN 'other_negative' ELSE 'sale' END AS line_class,
       count(*) AS lines, CAST(sum(Quantity) AS BIGINT) AS qty, CAST(sum(total_spend) AS DOUBLE) AS spend
FROM fact GROUP BY 1""")
def dirty_line_classes(spark, sf_dir):
    """All five classes of lines, with exact spend."""
    f = clean.clean_transactions(raw_invoices(spark, sf_dir)).withColumn("line_class", profile.line_class())
    return f.groupBy("line_class").agg(F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("qty"),
                                       F.sum(money("total_spend")).cast("double").alias("spend"))


@register("dirty_daily_series", covers=("A5", "A6", "J4", "N2"), oracle=_FACT_CTES.replace(
    "FROM typed t LEFT JOIN modes m ON t.StockCode = m.StockCode)", "FROM typed t LEFT JOIN modes m ON t.StockCode = m.StockCode WHERE InvoiceDate IS NOT NULL)")
    + "," + _DAILY_CTE + " SELECT * FROM daily")
def dirty_daily_series(spark, sf_dir):
    """The daily series where days have discounts and free items."""
    return series.daily_series(clean.clean_transactions(raw_invoices(spark, sf_dir)).where("InvoiceDate IS NOT NULL"))
