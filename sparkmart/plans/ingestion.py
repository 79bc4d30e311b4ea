"""Config-driven ingestion queries over the raw invoice table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkmart.config import parse_config
from sparkmart.operators import ingest
from sparkmart.plans.registry import register
from sparkmart.session import ensure_checkpoint_dir
from sparkmart.sources.bronze import INVOICE_CONFIG, RAW_SQL, raw_invoices

DT = "2024-11-09"
_PK = "document NULLS FIRST, item_code NULLS FIRST, units NULLS FIRST, list_price NULLS FIRST"
_COLUMNS = "document, item_code, units, list_price, price_value, item_text, buyer, sold_on, market, sold_at, sold_month"

_TYPED_SQL = f"""
WITH raw AS ({RAW_SQL}),
typed AS (
  SELECT trim(InvoiceNo) AS document, rtrim(StockCode) AS item_code,
         CAST(trunc(TRY_CAST(Quantity AS DECIMAL(38,10))) AS BIGINT) AS units,
         CAST(round(TRY_CAST(UnitPrice AS DECIMAL(12,3)), 1) AS DECIMAL(12,3)) AS list_price,
         TRY_CAST(UnitPrice AS DOUBLE) AS price_value,
         ltrim(Description) AS item_text,
         CAST(trunc(TRY_CAST(CustomerID AS DECIMAL(38,10))) AS INTEGER) AS buyer,
         CAST(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS DATE) AS sold_on,
         Country AS market,
         CAST(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS TIMESTAMP) AS sold_at,
         strftime(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M'), '%Y/%m') AS sold_month
  FROM raw)
"""

_DEDUP_CTE = f""",
dedup AS (
  SELECT DISTINCT ON (document, item_code, units, list_price) *
  FROM typed
  ORDER BY {_PK}, item_text NULLS FIRST, sold_on NULLS FIRST, price_value NULLS FIRST, buyer NULLS FIRST,
           market NULLS FIRST, sold_at NULLS FIRST, sold_month NULLS FIRST)"""

_SILVER_SQL = _TYPED_SQL + _DEDUP_CTE + f"""
SELECT row_number() OVER (ORDER BY {_PK}) AS _kde_id, {_COLUMNS}, DATE '{DT}' AS _ingestion_date,
       CAST(year(sold_on) AS INTEGER) AS ptn_yyyy, CAST(month(sold_on) AS INTEGER) AS ptn_mm,
       CAST(day(sold_on) AS INTEGER) AS ptn_dd
FROM dedup
"""

_NULLS_SQL = _TYPED_SQL + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_rows FROM typed"
    for c in ("document", "item_code", "units", "list_price", "sold_on", "market", "sold_at")) + ")"

_RAW_TEXT_SQL = f"WITH raw AS ({RAW_SQL}) SELECT * FROM raw"


@register("silver_ingest", oracle=_SILVER_SQL,
          covers=("P1", "P2", "P3", "P4", "P5", "P6", "P7", "P8", "P9", "P10", "P14", "N4", "N6",
                  "X1", "X7", "X8", "X9", "X18"))
def silver_ingest(spark, sf_dir):
    """Raw text invoices → typed, trimmed, de-duplicated, keyed, partition-tagged silver rows."""
    return ingest.silver(raw_invoices(spark, sf_dir), INVOICE_CONFIG, DT)


@register("ingest_null_violations", oracle=_NULLS_SQL, covers=("Q6",))
def ingest_null_violations(spark, sf_dir):
    """Per non-nullable column, rows whose typed value is NULL (failed parse or missing)."""
    cfg = parse_config(INVOICE_CONFIG)
    return ingest.null_violations(ingest.transform(raw_invoices(spark, sf_dir), cfg), cfg)


_STRICT = (("document", "InvoiceNo"), ("item_code", "StockCode"), ("units", "Quantity"), ("sold_on", "InvoiceDate"),
           ("list_price", "UnitPrice"), ("market", "Country"), ("sold_at", "InvoiceDate"))
_CHECKED_SQL = _TYPED_SQL.replace("  FROM raw)", "         , raw.* FROM raw)") + """, checked AS (
SELECT *, concat_ws(', ', """ + ", ".join(
    f"CASE WHEN {t} IS NULL THEN '{t}: ' || CASE WHEN {s} IS NULL THEN 'missing' ELSE 'unreadable' END END" for t, s in _STRICT) + """) AS why FROM typed)
"""


def _quarantined(spark, sf_dir):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarantine-{uuid.uuid4().hex}"
    return ingest.quarantine(raw_invoices(spark, sf_dir), parse_config(INVOICE_CONFIG), path)


@register("accepted_invoices", covers=("Q6", "Q7"), oracle=_CHECKED_SQL + f"SELECT {_COLUMNS} FROM checked WHERE why = ''")
def accepted_invoices(spark, sf_dir):
    """Typed rows that have every required value, read back from the checked write."""
    return _quarantined(spark, sf_dir)[0]


@register("rejected_invoices", covers=("Q6", "Q7"), oracle=_CHECKED_SQL
          + "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, why AS reasons FROM checked WHERE why <> ''")
def rejected_invoices(spark, sf_dir):
    """Source rows that lack a required value, with the reasons."""
    return _quarantined(spark, sf_dir)[1].withColumn("reasons", F.array_join("reasons", ", "))


@register("raw_invoices", oracle=_RAW_TEXT_SQL, covers=())
def raw_invoice_text(spark, sf_dir):
    """The all-text bronze table (dates formatted M/d/yyyy H:mm, padded codes)."""
    return raw_invoices(spark, sf_dir)
