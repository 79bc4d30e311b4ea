"""Daily demand series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators import series
from sparkmart.plans.registry import register
from sparkmart.plans.sqltext import with_fact
from sparkmart.sources.tables import table, transaction_fact

_DAILY_CTE = """
cls AS (
  SELECT *, CASE WHEN Quantity < 0 AND Description = 'Discount' THEN 'discount'
                 WHEN Quantity < 0 AND UnitPrice = 0 THEN 'free'
                 WHEN Quantity < 0 AND UnitPrice > 0 THEN 'refund'
                 WHEN Quantity < 0 THEN 'other_negative' ELSE 'sale' END AS c FROM fact),
base AS (
  SELECT CAST(InvoiceDate AS DATE) AS InvoiceDate, CAST(sum(abs(Quantity)) AS BIGINT) AS all_qty,
         count(DISTINCT StockCode) AS total_unique_item, sum(abs(total_spend)) AS all_sales FROM cls GROUP BY 1),
neg AS (
  SELECT CAST(InvoiceDate AS DATE) AS InvoiceDate,
         sum(total_spend) FILTER (WHERE c = 'refund') AS refund_sales,
         CAST(sum(Quantity) FILTER (WHERE c = 'refund') AS BIGINT) AS refund_qty,
         sum(total_spend) FILTER (WHERE c = 'discount') AS discount_sales,
         CAST(sum(Quantity) FILTER (WHERE c = 'free') AS BIGINT) AS free_qty
  FROM cls WHERE Quantity < 0 GROUP BY 1),
daily AS (
  SELECT b.InvoiceDate, b.all_qty, b.total_unique_item, CAST(b.all_sales AS DOUBLE) AS all_sales,
         CAST(coalesce(n.refund_sales, 0) AS DOUBLE) AS refund_sales, coalesce(n.refund_qty, 0) AS refund_qty,
         CAST(coalesce(n.discount_sales, 0) AS DOUBLE) AS discount_sales, coalesce(n.free_qty, 0) AS free_qty,
         CAST(b.all_sales + coalesce(n.refund_sales, 0) + coalesce(n.discount_sales, 0) AS DOUBLE) AS total_sales,
         b.all_qty + coalesce(n.refund_qty, 0) + coalesce(n.free_qty, 0) AS total_qty
  FROM base b LEFT JOIN neg n ON b.InvoiceDate = n.InvoiceDate)"""


def _daily(spark, sf_dir):
    return series.daily_series(transaction_fact(spark, sf_dir))


@register("daily_series", oracle=with_fact(extra_ctes=_DAILY_CTE, body="SELECT * FROM daily"),
          covers=("A5", "A6", "J4", "N2", "F10", "X10"))
def daily_series(spark, sf_dir):
    return _daily(spark, sf_dir)


_FEAT_SQL = with_fact(extra_ctes=_DAILY_CTE, body="""
SELECT InvoiceDate, total_qty, total_sales,
       CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS dayofweek, dayname(InvoiceDate) AS day_name,
       CAST(month(InvoiceDate) AS INTEGER) AS month, CAST(year(InvoiceDate) AS INTEGER) AS year,
       CAST(day(InvoiceDate) AS INTEGER) AS dayofmonth,
       lag(total_qty, 1) OVER w AS total_qty_lag1, lag(total_qty, 2) OVER w AS total_qty_lag2,
       lag(total_qty, 3) OVER w AS total_qty_lag3, lag(total_sales, 7) OVER w AS total_sales_lag7,
       round(avg(total_qty) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS total_qty_sma3,
       round(avg(total_qty) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS total_qty_sma7,
       round(avg(total_qty) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING), 6) AS total_qty_lag_sma7
FROM daily WINDOW w AS (ORDER BY InvoiceDate)""")


@register("daily_features", oracle=_FEAT_SQL, covers=("W6", "W7", "W8", "W11", "X8"))
def daily_features(spark, sf_dir):
    d = _daily(spark, sf_dir).select(series.DAY, "total_qty", "total_sales")
    d = series.calendar_features(d)
    d = series.add_lags(d, {"total_qty": [1, 2, 3], "total_sales": [7]})
    d = series.add_sma(d, "total_qty", [3, 7])
    return series.add_sma(d, "total_qty", [7], lagged=True)


_ACF_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
idx AS (SELECT row_number() OVER (ORDER BY InvoiceDate) - 1 AS t, total_sales AS x FROM daily),
cen AS (SELECT t, x - (SELECT avg(x) FROM idx) AS d FROM idx),
lags AS (SELECT range AS lag FROM range(0, 31))""", body="""
SELECT CAST(l.lag AS INTEGER) AS lag,
       round(sum(a.d * b.d) / (SELECT sum(d * d) FROM cen), 6) AS acf
FROM lags l JOIN cen a ON TRUE JOIN cen b ON b.t = a.t - l.lag
GROUP BY l.lag""")


@register("sales_acf", oracle=_ACF_SQL, covers=("W9",))
def sales_acf(spark, sf_dir):
    return series.autocorrelation(_daily(spark, sf_dir), "total_sales", 30)


_FFT_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
idx AS (SELECT row_number() OVER (ORDER BY InvoiceDate) - 1 AS t, total_sales AS x FROM daily),
nn AS (SELECT count(*) AS n FROM idx),
ks AS (SELECT range AS k FROM range(1, (SELECT n FROM nn) // 2 + 1)),
amp AS (
  SELECT k, sqrt(pow(sum(x * cos(2 * pi() * k * t / (SELECT n FROM nn))), 2)
              + pow(sum(x * sin(2 * pi() * k * t / (SELECT n FROM nn))), 2)) AS a
  FROM ks, idx GROUP BY k)""", body="""
SELECT CAST(row_number() OVER (ORDER BY a DESC, k) AS INTEGER) AS rank, CAST(k AS INTEGER) AS k,
       round((SELECT n FROM nn) / k, 3) AS period, round(a, 2) AS amplitude
FROM amp ORDER BY a DESC, k LIMIT 10""")


_ACF_COLUMNS = ["all_qty", "total_unique_item", "all_sales", "refund_sales", "refund_qty", "discount_sales", "free_qty",
                "total_sales", "total_qty"]
_ALL_ACF_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
long AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, InvoiceDate, CAST({c} AS DOUBLE) AS x FROM daily" for c in _ACF_COLUMNS) + """),
idx AS (SELECT feature, row_number() OVER (PARTITION BY feature ORDER BY InvoiceDate) - 1 AS t, x - avg(x) OVER (PARTITION BY feature) AS d FROM long),
den AS (SELECT feature, sum(d * d) AS den FROM idx GROUP BY feature),
lags AS (SELECT range AS lag FROM range(0, 31))""", body="""
SELECT a.feature, CAST(l.lag AS INTEGER) AS lag, round(CASE WHEN max(den) <> 0 THEN sum(a.d * b.d) / max(den) END, 6) AS acf
FROM lags l JOIN idx a ON TRUE JOIN idx b ON b.feature = a.feature AND b.t = a.t - l.lag JOIN den ON den.feature = a.feature
GROUP BY a.feature, l.lag""")


@register("daily_acf", oracle=_ALL_ACF_SQL, covers=("W9",))
def daily_acf(spark, sf_dir):
    """Autocorrelation of every daily column, all in one pass over the long form."""
    long = _daily(spark, sf_dir).select(series.DAY, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in _ACF_COLUMNS])).alias("v")).select(series.DAY, "v.*")
    return series.autocorrelation(long, "x", 30, ["feature"])


@register("sales_spectrum", oracle=_FFT_SQL, covers=("W10",))
def sales_spectrum(spark, sf_dir):
    return series.spectrum(_daily(spark, sf_dir), "total_sales", 10)


_FOLD_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
idx AS (SELECT InvoiceDate, row_number() OVER (ORDER BY InvoiceDate) - 1 AS t, count(*) OVER () AS n FROM daily),
f AS (SELECT range AS fold FROM range(0, 5))""", body="""
SELECT CAST(fold AS INTEGER) AS fold, InvoiceDate, role FROM (
  SELECT fold, InvoiceDate,
         CASE WHEN t < n - (5 - fold) * (n // 6) THEN 'train'
              WHEN t < n - (5 - fold) * (n // 6) + (n // 6) THEN 'test' END AS role
  FROM idx, f) WHERE role IS NOT NULL""")


@register("ts_folds", oracle=_FOLD_SQL, covers=("W12",))
def ts_folds(spark, sf_dir):
    return series.time_series_folds(_daily(spark, sf_dir), 5)


_SPLIT_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
idx AS (SELECT InvoiceDate, total_qty, row_number() OVER (ORDER BY InvoiceDate) - 1 AS t,
               count(*) OVER () AS n FROM daily)""", body="""
SELECT InvoiceDate, total_qty, t, CASE WHEN t < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM idx""")


@register("chrono_split", oracle=_SPLIT_SQL, covers=("W13",))
def chrono_split(spark, sf_dir):
    d = _daily(spark, sf_dir).select(series.DAY, "total_qty")
    return series.chronological_split(d).select(series.DAY, "total_qty", F.col("t").cast("long").alias("t"), "split")


_BASE_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
idx AS (SELECT InvoiceDate, CAST(total_qty AS DOUBLE) AS y, row_number() OVER (ORDER BY InvoiceDate) - 1 AS t,
               count(*) OVER () AS n FROM daily),
tr AS (SELECT avg(y) AS p FROM idx WHERE t < floor(n * 0.8)),
te AS (SELECT y, p FROM idx, tr WHERE t >= floor(n * 0.8))""", body="""
SELECT round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
       round(100 * avg(CASE WHEN y <> 0 THEN abs(p - y) / abs(y) END), 4) AS mape FROM te""")


@register("baseline_forecast_metrics", oracle=_BASE_SQL, covers=("M24", "W13"))
def baseline_forecast_metrics(spark, sf_dir):
    d = _daily(spark, sf_dir).select(series.DAY, F.col("total_qty").cast("double").alias("total_qty"))
    return series.forecast_metrics(series.mean_baseline(d, "total_qty"), "label", "prediction")


_MINMAX_SQL = with_fact(extra_ctes=_DAILY_CTE, body="""
SELECT InvoiceDate,
       (all_qty - min(all_qty) OVER ()) / (max(all_qty) OVER () - min(all_qty) OVER ()) AS all_qty,
       (total_unique_item - min(total_unique_item) OVER ()) /
         (max(total_unique_item) OVER () - min(total_unique_item) OVER ()) AS total_unique_item,
       (all_sales - min(all_sales) OVER ()) / (max(all_sales) OVER () - min(all_sales) OVER ()) AS all_sales
FROM daily""")


@register("daily_minmax", oracle=_MINMAX_SQL, covers=("M2", "J9"))
def daily_minmax(spark, sf_dir):
    d = _daily(spark, sf_dir)
    return series.minmax(d, ["all_qty", "total_unique_item", "all_sales"])


# The generated labels, for the oracle's columns only; the query reads its own.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _segment_fact(spark, sf_dir):
    seg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), "c_mktsegment")
    return transaction_fact(spark, sf_dir).join(seg, "CustomerID")


_PIVOT_SQL = with_fact(body="SELECT CAST(f.InvoiceDate AS DATE) AS InvoiceDate, " + ", ".join(
    f"count(DISTINCT f.InvoiceNo) FILTER (WHERE c.c_mktsegment = '{s}') AS segment_{s}" for s in SEGMENTS)
    + " FROM fact f JOIN customer c ON f.CustomerID = c.c_custkey GROUP BY 1")


@register("daily_segment_pivot", oracle=_PIVOT_SQL, covers=("A12", "P12"))
def daily_segment_pivot(spark, sf_dir):
    """Invoices per day and customer segment, one column per segment."""
    return series.pivot_counts(_segment_fact(spark, sf_dir), "c_mktsegment", prefix="segment_")


_COUNTED_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
seg AS (SELECT CAST(f.InvoiceDate AS DATE) AS d, """ + ", ".join(
    f"count(DISTINCT f.InvoiceNo) FILTER (WHERE c.c_mktsegment = '{s}') AS segment_{s}" for s in SEGMENTS) + """
  FROM fact f JOIN customer c ON f.CustomerID = c.c_custkey GROUP BY 1)""",
    body="SELECT daily.*, " + ", ".join(f"coalesce(segment_{s}, 0) AS segment_{s}" for s in SEGMENTS)
    + " FROM daily LEFT JOIN seg ON daily.InvoiceDate = seg.d")


@register("daily_label_counts", oracle=_COUNTED_SQL, covers=("J5", "J6"))
def daily_label_counts(spark, sf_dir):
    """The daily frame with its invoices counted by their customers' label."""
    labels = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), "c_mktsegment")
    return series.with_label_counts(_daily(spark, sf_dir), transaction_fact(spark, sf_dir), labels,
                                    "CustomerID", "c_mktsegment", "segment_")


@register("sma_cv_scores", covers=("M22", "W8", "W12"))
def sma_cv_scores(spark, sf_dir):
    """Boosted regressors on lagged moving averages of 1 to 15 days beside the other lagged daily columns, expanding folds."""
    from sparkmart.operators import forecast
    from sparkmart.session import reliable_checkpoint
    daily = reliable_checkpoint(_daily(spark, sf_dir).select(series.DAY, "total_qty", "all_qty", "total_unique_item"))
    return forecast.sma_cross_validation(daily, "total_qty")


@register("lag_cv_scores", covers=("M21", "W6", "W12", "F14"))
def lag_cv_scores(spark, sf_dir):
    """Decision-tree and boosted regressors on lags of the daily columns, expanding folds."""
    from sparkmart.operators import forecast
    from sparkmart.session import reliable_checkpoint
    daily = reliable_checkpoint(_daily(spark, sf_dir).select(series.DAY, "total_qty", "all_qty", "total_unique_item"))
    return forecast.lag_cross_validation(daily, "total_qty")


_MATRIX_SQL = with_fact(extra_ctes=_DAILY_CTE + """,
seg AS (SELECT CAST(f.InvoiceDate AS DATE) AS d, """ + ", ".join(
    f"count(DISTINCT f.InvoiceNo) FILTER (WHERE c.c_mktsegment = '{s}') AS cluster_{i}" for i, s in enumerate(SEGMENTS)) + """
  FROM fact f JOIN customer c ON f.CustomerID = c.c_custkey GROUP BY 1)""",
    body="SELECT InvoiceDate, CAST(total_qty AS DOUBLE) AS total_qty, "
    + "CASE WHEN day(InvoiceDate) = 1 OR (month(InvoiceDate) = 12 AND day(InvoiceDate) >= 25) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_holiday, "
    + "round(avg(total_sales) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING), 4) AS total_sales_lag_sma7, "
    + ", ".join(f"CAST(lag({c}, {n}) OVER w AS DOUBLE) AS {c}_lag{n}" for c, n in (
        ("total_unique_item", 6), ("refund_sales", 12), ("free_qty", 16), ("total_sales", 6)))
    + ", " + ", ".join(f"CAST(lag(coalesce(cluster_{i}, 0), {n}) OVER w AS DOUBLE) AS cluster_{i}_lag{n}" for i, n in enumerate((6, 6, 6, 12, 6)))
    + """, CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS dayofweek, CAST(month(InvoiceDate) AS INTEGER) AS month,
       CAST(year(InvoiceDate) AS INTEGER) AS year, CAST(day(InvoiceDate) AS INTEGER) AS dayofmonth
FROM daily LEFT JOIN seg ON daily.InvoiceDate = seg.d WINDOW w AS (ORDER BY InvoiceDate)""")


def _demand_frame(spark, sf_dir, fact, labels, label):
    """The feature matrix with the invoices counted by their customers' label."""
    from sparkmart.operators import forecast
    from sparkmart.plans.stores import holiday_calendar
    daily = series.with_label_counts(series.daily_series(fact), fact, labels, "CustomerID", label)
    return forecast.demand_features(series.add_holidays(daily, holiday_calendar(spark, sf_dir)))


@register("demand_matrix", oracle=_MATRIX_SQL, covers=("W6", "W8", "W11", "J6", "J7"))
def demand_matrix(spark, sf_dir):
    """The demand model's feature matrix, its counts by market segment (which SQL can tell)."""
    segment = F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("c_mktsegment")) - 1
    labels = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), segment.alias("label"))
    return _demand_frame(spark, sf_dir, transaction_fact(spark, sf_dir), labels, "label").withColumn("total_sales_lag_sma7", F.round("total_sales_lag_sma7", 4))


def _clustered_frame(spark, sf_dir):
    """The feature matrix with counts by the k-means cluster of the customers (J5).  The
    profile, the daily series and the counts read one written fact: its joins run once."""
    from sparkmart.plans.segments import labelled_customers
    from sparkmart.session import reliable_checkpoint
    fact = reliable_checkpoint(transaction_fact(spark, sf_dir).drop("Country"))
    return reliable_checkpoint(_demand_frame(spark, sf_dir, fact, labelled_customers(spark, sf_dir, fact), "cluster"))


@register("demand_search", covers=("M23", "J5", "W12"))
def demand_search(spark, sf_dir):
    """100 draws of the published grid on 10 expanding folds of the training days, by successive
    halving (the operator's default grows all of them in full, which README times)."""
    from sparkmart.operators import forecast
    frame = _clustered_frame(spark, sf_dir)
    train = series.chronological_split(frame).where("split = 'train'").drop("split", "t")
    return forecast.search_table(spark, forecast.random_search(train, "total_qty", halving=3))


@register("forecast_scores", covers=("M23", "M24", "W13", "J5"))
def forecast_scores(spark, sf_dir):
    """The published final model vs the train-mean baseline on the last 20 % of days."""
    from sparkmart.operators import forecast
    return forecast.fit_and_score(_clustered_frame(spark, sf_dir), "total_qty")
