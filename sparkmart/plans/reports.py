"""Profiling and report queries (EDA) over the fact, raw text and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators import profile
from sparkmart.plans.registry import register
from sparkmart.plans.sqltext import hu, with_fact
from sparkmart.sources.bronze import RAW_SQL, raw_invoices
from sparkmart.sources.tables import table, transaction_fact

FACT_COLS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
             "CustomerID", "Country", "total_spend")


def _union(parts):
    return " UNION ALL ".join(parts)


_NULL_SQL = with_fact(body="SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM fact"
     for c in FACT_COLS]) + ")")


@register("null_profile", oracle=_NULL_SQL, covers=("A10", "F2"))
def null_profile(spark, sf_dir):
    return profile.null_profile(transaction_fact(spark, sf_dir))


_EXACT_MEAN = {  # exact half-up mean at 6 places for exact (decimal / integer) columns
    "Quantity": "CAST(" + hu("CAST(sum(Quantity) AS HUGEINT) * 1000000", "count(Quantity)") + " AS DOUBLE) / 1e6",
    "total_spend": "CAST(" + hu("CAST(sum(total_spend) * 100 AS HUGEINT) * 10000", "count(total_spend)")
                   + " AS DOUBLE) / 1e6",
}


def _describe_sql(cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        mean = _EXACT_MEAN.get(c, f"round(avg({x}), 6)")
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS count, {mean} AS mean, "
            f"round(stddev_samp({x}), 6) AS std, min({x}) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50, "
            f"round(quantile_cont({x}, 0.75), 6) AS q75, max({x}) AS max FROM fact")
    return with_fact(body=_union(parts))


_DESC_COLS = ["Quantity", "UnitPrice", "total_spend"]


@register("describe_fact", oracle=_describe_sql(_DESC_COLS), covers=("A11", "A14"))
def describe_fact(spark, sf_dir):
    return profile.describe(transaction_fact(spark, sf_dir), _DESC_COLS)


@register("sales_by_country",
          oracle=with_fact(body="SELECT Country, CAST(sum(total_spend) AS DOUBLE) AS total, count(*) AS lines "
                                "FROM fact GROUP BY Country"),
          covers=("A8", "T4"))
def sales_by_country(spark, sf_dir):
    return profile.sum_by(transaction_fact(spark, sf_dir), "Country").orderBy("Country")


@register("sales_by_hour",
          oracle="SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, "
                 "count(*) AS lines FROM events GROUP BY hour(ts)",
          covers=("A8", "X8"))
def sales_by_hour(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return profile.sum_by(ev, F.hour("ts").alias("hour"), "value")


@register("top_descriptions",
          oracle=with_fact(body="SELECT * FROM (SELECT Description, CAST(sum(Quantity) AS BIGINT) AS sum_Quantity "
                                "FROM fact GROUP BY Description ORDER BY sum_Quantity DESC, Description LIMIT 10)"),
          covers=("T1", "T2", "W14"))
def top_descriptions(spark, sf_dir):
    return profile.top_n(transaction_fact(spark, sf_dir), "Description", "Quantity", 10, ascending_after=True)


@register("country_value_counts",
          oracle=with_fact(body="SELECT Country, count(*) AS count FROM fact GROUP BY Country"),
          covers=("A9",))
def country_value_counts(spark, sf_dir):
    return profile.value_counts(transaction_fact(spark, sf_dir), "Country")


@register("line_classes", oracle=with_fact(body="""
SELECT cls AS line_class, count(*) AS lines, CAST(sum(Quantity) AS BIGINT) AS qty,
       CAST(sum(total_spend) AS DOUBLE) AS spend
FROM (SELECT *, CASE WHEN Quantity < 0 AND Description = 'Discount' THEN 'discount'
                     WHEN Quantity < 0 AND UnitPrice = 0 THEN 'free'
                     WHEN Quantity < 0 AND UnitPrice > 0 THEN 'refund'
                     WHEN Quantity < 0 THEN 'other_negative' ELSE 'sale' END AS cls FROM fact)
GROUP BY cls"""), covers=("F10", "F4"))
def line_classes(spark, sf_dir):
    f = transaction_fact(spark, sf_dir).withColumn("line_class", profile.line_class())
    return f.groupBy("line_class").agg(F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("qty"),
                                       F.sum("total_spend").cast("double").alias("spend"))


_PROBE_SQL = f"""
WITH raw AS ({RAW_SQL})
SELECT probe, CAST(n AS BIGINT) AS rows FROM (
  SELECT 'invoice_no_non_digit' AS probe,
         count(*) FILTER (WHERE regexp_matches(regexp_replace(InvoiceNo, '^[CA]', ''), '\\D')) AS n FROM raw
  UNION ALL SELECT 'quantity_non_digit',
         count(*) FILTER (WHERE regexp_matches(replace(Quantity, '-', ''), '\\D')) FROM raw
  UNION ALL SELECT 'quantity_has_dot', count(*) FILTER (WHERE contains(Quantity, '.')) FROM raw
  UNION ALL SELECT 'customer_id_non_digit', count(*) FILTER (WHERE regexp_matches(CustomerID, '\\D')) FROM raw
  UNION ALL SELECT 'refund_invoice', count(*) FILTER (WHERE starts_with(InvoiceNo, 'C')) FROM raw)
"""


@register("quality_probes", oracle=_PROBE_SQL, covers=("F9", "X3", "X12"))
def quality_probes(spark, sf_dir):
    return profile.quality_probes(raw_invoices(spark, sf_dir))


@register("short_stock_codes",
          oracle=with_fact(body="SELECT StockCode, count(*) AS lines FROM fact WHERE length(StockCode) < 8 "
                                "GROUP BY StockCode"),
          covers=("F7",))
def short_stock_codes(spark, sf_dir):
    return profile.code_length_counts(transaction_fact(spark, sf_dir), "StockCode", 8)


@register("duplicate_raw_rows", oracle=f"""
WITH raw AS ({RAW_SQL})
SELECT *, count(*) AS copies FROM raw GROUP BY ALL HAVING count(*) > 1""", covers=("N7",))
def duplicate_raw_rows(spark, sf_dir):
    return profile.duplicate_rows(raw_invoices(spark, sf_dir))


@register("raw_row_counts", oracle=f"""
WITH raw AS ({RAW_SQL})
SELECT (SELECT count(*) FROM raw) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS distinct_rows
""", covers=("N8", "A19"))
def raw_row_counts(spark, sf_dir):
    return profile.row_counts(raw_invoices(spark, sf_dir))


_OUTLIER_SQL = with_fact(extra_ctes="""
q AS (SELECT quantile_cont(CAST(Quantity AS DOUBLE), 0.25) AS q1,
             quantile_cont(CAST(Quantity AS DOUBLE), 0.75) AS q3 FROM fact),
iqr AS (SELECT f.* FROM fact f, q
        WHERE f.Quantity < q.q3 + 1.5 * (q.q3 - q.q1) AND f.Quantity > q.q1 - 1.5 * (q.q3 - q.q1)),
z AS (SELECT avg(UnitPrice) AS m, stddev_pop(UnitPrice) AS s FROM iqr)""",
                         body="SELECT i.* FROM iqr i, z WHERE abs((i.UnitPrice - z.m) / z.s) < 3")


@register("outlier_filtered", oracle=_OUTLIER_SQL, covers=("F11", "F12", "J9", "F3"))
def outlier_filtered(spark, sf_dir):
    return profile.remove_outliers(transaction_fact(spark, sf_dir), "Quantity", "UnitPrice")


_CORR_COLS = ["Quantity", "UnitPrice", "total_spend"]
_CORR_SQL = with_fact(body=_union(
    [f"SELECT '{a}' AS x, '{b}' AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM fact"
     for a in _CORR_COLS for b in _CORR_COLS]))


@register("fact_correlation", oracle=_CORR_SQL, covers=("A17",))
def fact_correlation(spark, sf_dir):
    return profile.correlation_long(transaction_fact(spark, sf_dir), _CORR_COLS)


@register("monthly_growth", oracle=with_fact(body="""
SELECT month, CAST(sales AS DOUBLE) AS sales,
       CAST(round(CAST((sales - lag(sales) OVER (ORDER BY month)) AS DOUBLE)
                  / nullif(lag(sales) OVER (ORDER BY month), 0), 6) AS DOUBLE) AS growth
FROM (SELECT CAST(date_trunc('month', InvoiceDate) AS DATE) AS month, sum(total_spend) AS sales
      FROM fact GROUP BY 1)"""), covers=("A18",))
def monthly_growth(spark, sf_dir):
    return profile.monthly_growth(transaction_fact(spark, sf_dir))


@register("negative_brand_lines", oracle=with_fact(body="""
SELECT InvoiceNo, StockCode, Description, Quantity, total_spend FROM fact
WHERE Quantity < 0 AND StockCode = 'Brand#1' AND contains(Description, 'rod') AND NOT (total_spend >= 0)"""),
          covers=("F3", "F5", "F6"))
def negative_brand_lines(spark, sf_dir):
    f = transaction_fact(spark, sf_dir)
    cond = ((F.col("Quantity") < 0) & (F.col("StockCode") == "Brand#1") & F.col("Description").contains("rod")
            & ~(F.col("total_spend") >= 0))
    return f.filter(cond).select("InvoiceNo", "StockCode", "Description", "Quantity", "total_spend")
