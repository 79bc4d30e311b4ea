"""Clean & load of the raw invoice table (part B).

``clean_transactions`` is one lazy plan: fills, typed casts, ``total_spend``,
upper-cased stock codes and the most-frequent-description repair, with the
original column order kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.columns import safe_long_id
from sparkmart.functions.rules import typed

FACT_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                "CustomerID", "Country", "total_spend")
NO_DESCRIPTION = "No Description"


def description_mode(df: DataFrame, key: str = "StockCode", value: str = "Description") -> DataFrame:
    """Most frequent ``value`` per ``key``; ties go to the smallest text.

    Two aggregates (count per (key, value), then ``min_by`` over
    (-count, value) per key) — both combine map-side, so one hot key costs one
    row per distinct value, not one row per line."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(
        F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(value))


def repair_descriptions(df: DataFrame, key: str = "StockCode", value: str = "Description") -> DataFrame:
    """Replace each line's description by its code's most frequent one.

    The mode table has one row per distinct code; AQE broadcasts it when its
    runtime size is under the threshold and otherwise runs a sort-merge join
    that splits a hot code's partition."""
    modes = description_mode(df, key, value)
    return df.drop(value).join(modes, key, "left").select(*df.columns)


def clean_transactions(raw: DataFrame, date_format: str = "M/d/yyyy H:mm") -> DataFrame:
    """Raw text (or loosely typed) invoice lines → the clean fact (FIXTURES §3)."""
    qty = typed(F.col("Quantity").cast("string"), "int")
    price = F.col("UnitPrice").cast("string").try_cast("decimal(18,4)")
    ts = F.coalesce(F.try_to_timestamp(F.col("InvoiceDate").cast("string"), F.lit(date_format)),
                    F.col("InvoiceDate").cast("string").try_cast("timestamp"))
    df = raw.select(
        F.col("InvoiceNo").cast("string").alias("InvoiceNo"),
        F.upper(F.col("StockCode").cast("string")).alias("StockCode"),  # X2
        F.coalesce(F.col("Description").cast("string"), F.lit(NO_DESCRIPTION)).alias("Description"),  # N1
        qty.alias("Quantity"),
        ts.alias("InvoiceDate"),
        price.cast("double").alias("UnitPrice"),
        F.coalesce(safe_long_id(F.col("CustomerID").cast("string")), F.lit(0).cast("bigint")).alias("CustomerID"),
        F.col("Country").cast("string").alias("Country"),
        (qty.cast("decimal(10,0)") * price).cast("double").alias("total_spend"),  # P11, exact product
    )
    return repair_descriptions(df)
