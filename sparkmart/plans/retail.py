"""Fact mapping and customer-profile queries."""

from __future__ import annotations

from sparkmart.operators import rfm
from sparkmart.plans.registry import register
from sparkmart.plans.sqltext import cents, days, hu, hu2, with_fact
from sparkmart.sources.tables import transaction_fact

_RFM_CTES = f"""
known AS (SELECT * FROM fact WHERE CustomerID <> 0),
per_inv AS (
  SELECT CustomerID, InvoiceNo, sum(total_spend) AS inv_spend,
         sum(CAST(Quantity AS BIGINT)) AS inv_qty, count(DISTINCT StockCode) AS inv_items,
         min(InvoiceDate) AS inv_date
  FROM known GROUP BY CustomerID, InvoiceNo),
owner AS (
  SELECT DISTINCT ON (InvoiceNo) InvoiceNo, inv_date AS InvoiceDate, CustomerID
  FROM per_inv ORDER BY InvoiceNo, inv_date, CustomerID),
seq AS (
  SELECT CustomerID, InvoiceDate,
         lag(InvoiceDate, 1) OVER w AS p1, lag(InvoiceDate, 2) OVER w AS p2,
         row_number() OVER w AS rn
  FROM owner WINDOW w AS (PARTITION BY CustomerID ORDER BY InvoiceDate, InvoiceNo)),
gaps AS (
  SELECT CustomerID, InvoiceDate, rn, {days('InvoiceDate', 'p1')} AS gap,
         abs({days('InvoiceDate', 'p1')} - {days('p1', 'p2')}) AS gap_change
  FROM seq),
latest AS (SELECT max(InvoiceDate) AS latest FROM owner),
rec AS (
  SELECT CustomerID,
         CASE WHEN count(*) = 1 THEN {days('max(latest)', 'max(InvoiceDate)')}
              ELSE arg_max(gap, rn) END AS recency,
         sum(gap_change) AS sc, count(gap_change) AS nc
  FROM gaps CROSS JOIN latest GROUP BY CustomerID),
tot AS (
  SELECT CustomerID, count(*) AS frequency, sum(inv_spend) AS spend,
         sum(inv_qty) AS qty, sum(inv_items) AS items
  FROM per_inv GROUP BY CustomerID),
per_month AS (
  SELECT CustomerID, month(InvoiceDate) AS m, count(DISTINCT InvoiceNo) AS m_inv,
         {hu(cents('sum(total_spend)') + ' * 10000', 'count(*)')} AS m_mean_micro
  FROM known GROUP BY CustomerID, month(InvoiceDate)),
mon AS (
  SELECT CustomerID, {hu2('100 * sum(m_inv)', 'count(*)')} AS freq_per_month,
         {hu2('sum(m_mean_micro)', 'count(*) * 10000')} AS mean_spent_per_month
  FROM per_month GROUP BY CustomerID),
profile AS (
SELECT r.CustomerID, CAST(r.recency AS INTEGER) AS recency, CAST(t.frequency AS BIGINT) AS frequency,
       CAST(t.spend AS DOUBLE) AS monetary,
       CAST(CASE WHEN t.frequency = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_first_time_buyer,
       CASE WHEN r.nc > 0 THEN {hu2("100 * r.sc", "r.nc")} ELSE CAST(r.recency AS DOUBLE) END
         AS mean_time_interval,
       {hu2(cents("t.spend"), "t.frequency")} AS mean_ticket_size,
       {hu2("100 * t.qty", "t.frequency")} AS mean_quantity,
       {hu2("100 * t.items", "t.frequency")} AS mean_unique_item,
       m.freq_per_month, m.mean_spent_per_month
FROM rec r JOIN tot t ON r.CustomerID = t.CustomerID JOIN mon m ON r.CustomerID = m.CustomerID)"""

# Profile as reusable CTEs (``profile``) for the oracles built on top of it.
RFM_CTES = _RFM_CTES
_RFM_SQL = with_fact(extra_ctes=RFM_CTES, body="SELECT * FROM profile")


@register("rfm_profile", oracle=_RFM_SQL,
          covers=("F1", "A1", "A2", "A3", "A4", "W1", "W2", "W3", "W4", "J1", "J2", "N3", "N5", "X11", "J9"))
def rfm_profile(spark, sf_dir):
    return rfm.customer_profile(transaction_fact(spark, sf_dir))


@register("transaction_fact", oracle=with_fact(body="SELECT * FROM fact"), covers=("S4",))
def fact(spark, sf_dir):
    return transaction_fact(spark, sf_dir)
