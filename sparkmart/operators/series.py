"""Daily demand series and its features (forecasting part of D).

Scale note: the heavy step is ``daily_series`` — a partial aggregate of all
lines per (series key, day).  Its output has one row per calendar day per
series, so it is bounded by the date range (thousands of rows per series),
not by the data volume.  The feature windows below partition by the series
key (when given) and otherwise run over that bounded table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.columns import money
from sparkmart.operators.profile import line_class
from sparkmart.session import reliable_checkpoint

DAY = "InvoiceDate"


def _w(series_key: list[str] | None, order: str = DAY) -> Window:
    w = Window.orderBy(order)
    return w.partitionBy(*series_key) if series_key else w


def daily_series(fact: DataFrame, series_key: list[str] | None = None) -> DataFrame:
    """A5 + A6 + N2 + J4 in ONE conditional aggregate per day:

    all_qty = Σ|Quantity|, total_unique_item = distinct stock codes,
    all_sales = Σ|spend|; refund_sales / refund_qty, discount_sales, free_qty
    from the negative lines (F10 classes), 0 when a day has none;
    total_sales = all_sales + refund_sales + discount_sales,
    total_qty = all_qty + refund_qty + free_qty.
    """
    keys = list(series_key or [])
    cls = line_class()
    spend = money("total_spend")
    agg = (fact.withColumn("_cls", cls)
               .groupBy(*keys, F.to_date(DAY).alias(DAY))
               .agg(F.sum(F.abs(F.col("Quantity")).cast("long")).alias("all_qty"),
                    F.countDistinct("StockCode").alias("total_unique_item"),
                    F.sum(F.abs(spend)).alias("_all_sales"),
                    F.sum(F.when(F.col("_cls") == "refund", spend)).alias("_refund_sales"),
                    F.sum(F.when(F.col("_cls") == "refund", F.col("Quantity").cast("long"))).alias("_refund_qty"),
                    F.sum(F.when(F.col("_cls") == "discount", spend)).alias("_discount_sales"),
                    F.sum(F.when(F.col("_cls") == "free", F.col("Quantity").cast("long"))).alias("_free_qty")))
    z = lambda c, t: F.coalesce(F.col(c), F.lit(0).cast(t))
    return agg.select(
        *keys, DAY,
        F.col("all_qty"), F.col("total_unique_item").cast("long").alias("total_unique_item"),
        F.col("_all_sales").cast("double").alias("all_sales"),
        z("_refund_sales", "decimal(28,2)").cast("double").alias("refund_sales"),
        z("_refund_qty", "long").alias("refund_qty"),
        z("_discount_sales", "decimal(28,2)").cast("double").alias("discount_sales"),
        z("_free_qty", "long").alias("free_qty"),
        (F.col("_all_sales") + z("_refund_sales", "decimal(28,2)") + z("_discount_sales", "decimal(28,2)"))
        .cast("double").alias("total_sales"),
        (F.col("all_qty") + z("_refund_qty", "long") + z("_free_qty", "long")).alias("total_qty"))


def calendar_features(df: DataFrame, day: str = DAY) -> DataFrame:
    """Dayofweek (Monday = 0), day_name, month, year, dayofmonth."""
    return df.select("*", F.weekday(day).alias("dayofweek"), F.date_format(day, "EEEE").alias("day_name"),
                     F.month(day).alias("month"), F.year(day).alias("year"), F.dayofmonth(day).alias("dayofmonth"))


def add_holidays(df: DataFrame, holidays: DataFrame, day: str = DAY) -> DataFrame:
    """``is_holiday`` from a holiday calendar; dates listed twice count once."""
    cal = holidays.select(F.col(holidays.columns[0]).cast("date").alias("_hday")).distinct()
    j = df.join(cal, F.col(day) == F.col("_hday"), "left")
    return j.withColumn("is_holiday", F.col("_hday").isNotNull().cast("int")).drop("_hday")


def add_lags(df: DataFrame, spec: dict[str, list[int]], series_key: list[str] | None = None) -> DataFrame:
    """``{col}_lag{n}`` = value n rows earlier (row-based, not calendar)."""
    w = _w(series_key)
    return df.select("*", *[F.lag(c, n).over(w).alias(f"{c}_lag{n}") for c, ns in spec.items() for n in ns])


def add_sma(df: DataFrame, col: str, windows: list[int], lagged: bool = False,
            series_key: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Simple moving average over the last i rows (partial windows at
    the start, i.e. min_periods=0).  ``lagged=True`` shifts it by i rows in
    the same frame: rows [-(2i-1), -i] — SMA then shift, in one pass."""
    w = _w(series_key)
    cols = []
    for i in windows:
        frame = w.rowsBetween(-(2 * i - 1), -i) if lagged else w.rowsBetween(-(i - 1), 0)
        name = f"{col}_lag_sma{i}" if lagged else f"{col}_sma{i}"
        cols.append(F.round(F.avg(F.col(col)).over(frame), digits).alias(name))
    return df.select("*", *cols)


def with_row_index(df: DataFrame, series_key: list[str] | None = None, name: str = "t") -> DataFrame:
    """0-based position of each day inside its series."""
    return df.withColumn(name, F.row_number().over(_w(series_key)) - 1)


def autocorrelation(df: DataFrame, col: str, max_lag: int = 30, series_key: list[str] | None = None,
                    digits: int = 6) -> DataFrame:
    """acf(k) = Σ_t (x_t - m)(x_{t-k} - m) / Σ_t (x_t - m)², k = 0..max_lag.

    The lagged pairs come from an equi-join on position (t = s + k) after
    exploding each row into its max_lag+1 shifted copies.  A constant series
    has no autocorrelation (NULL)."""
    keys = list(series_key or [])
    idx = with_row_index(df.select(*keys, DAY, F.col(col).cast("double").alias("x")), series_key)
    m = idx.groupBy(*keys).agg(F.avg("x").alias("m"), F.sum(F.lit(1)).alias("n"))
    cen = idx.join(m, keys) if keys else idx.crossJoin(F.broadcast(m))
    cen = cen.select(*keys, "t", (F.col("x") - F.col("m")).alias("d"))
    shifted = cen.select(*keys, F.col("t").alias("s"), F.col("d").alias("d_prev"),
                         F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"))
    shifted = shifted.withColumn("t", F.col("s") + F.col("lag"))
    pairs = cen.join(shifted, keys + ["t"]).select(*keys, "lag", (F.col("d") * F.col("d_prev")).alias("p"))
    num = pairs.groupBy(*keys, "lag").agg(F.sum("p").alias("num"))
    den = cen.groupBy(*keys).agg(F.sum(F.col("d") * F.col("d")).alias("den"))
    j = num.join(den, keys) if keys else num.crossJoin(F.broadcast(den))
    return j.select(*keys, "lag", F.round(F.try_divide("num", "den"), digits).alias("acf"))


def spectrum(df: DataFrame, col: str, top: int = 10, series_key: list[str] | None = None) -> DataFrame:
    """Amplitudes |Σ_t x_t e^(-2πikt/N)| of the frequencies k = 1..N/2, the
    ``top`` largest with their period N/k.

    Every day meets every frequency (half the squared number of days, bounded by
    the calendar, whatever the number of lines) and two sums by frequency are
    combined map-side; the angle is reduced modulo N before it is taken, so it
    stays exact for long series."""
    keys = list(series_key or [])
    idx = with_row_index(df.select(*keys, DAY, F.col(col).cast("double").alias("x")), series_key)
    n = idx.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    j = idx.join(n, keys) if keys else idx.crossJoin(F.broadcast(n))
    j = j.where("n > 1").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("n") / 2))))
    angle = 2 * math.pi * F.pmod(F.col("k") * F.col("t"), F.col("n")) / F.col("n")
    amp = (j.groupBy(*keys, "n", "k").agg(F.sum(F.col("x") * F.cos(angle)).alias("re"), F.sum(F.col("x") * F.sin(angle)).alias("im"))
           .withColumn("a", F.hypot("re", "im")))
    order = Window.partitionBy(*keys).orderBy(F.desc("a"), "k")
    ranked = amp.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(*keys, F.col("rank").cast("int"), F.col("k").cast("int").alias("k"),
                         F.round(F.col("n") / F.col("k"), 3).alias("period"), F.round("a", 2).alias("amplitude"))


def time_series_folds(df: DataFrame, n_splits: int = 5, series_key: list[str] | None = None) -> DataFrame:
    """Expanding-window folds.  test size = n // (n_splits + 1); fold f
    tests rows [n - (n_splits - f)·size, … + size) and trains on every row
    before it.  Output: one row per (fold, day) with role train/test."""
    keys = list(series_key or [])
    idx = with_row_index(df.select(*keys, DAY), series_key)
    n = idx.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    j = idx.join(n, keys) if keys else idx.crossJoin(F.broadcast(n))
    size = F.floor(F.col("_n") / (n_splits + 1))
    j = j.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("_n") - (F.lit(n_splits) - F.col("fold")) * size
    role = F.when(F.col("t") < start, "train").when(F.col("t") < start + size, "test")
    return j.select(*keys, "fold", DAY, role.alias("role")).filter(F.col("role").isNotNull())


def chronological_split(df: DataFrame, train_fraction: float = 0.8,
                        series_key: list[str] | None = None) -> DataFrame:
    """The first floor(fraction · n) days train, the rest test."""
    keys = list(series_key or [])
    idx = with_row_index(df, series_key)
    n = idx.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    j = idx.join(n, keys) if keys else idx.crossJoin(F.broadcast(n))
    cut = F.floor(F.col("_n") * F.lit(train_fraction))
    return j.withColumn("split", F.when(F.col("t") < cut, "train").otherwise("test")).drop("_n")


def forecast_metrics(pred: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """RMSE and MAPE (%), rows with a zero actual excluded from MAPE."""
    e = F.col(prediction) - F.col(label)
    return pred.agg(F.round(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
                    F.round(100 * F.avg(F.when(F.col(label) != 0, F.abs(e) / F.abs(F.col(label)))), digits)
                    .alias("mape"))


def mean_baseline(series: DataFrame, col: str, compat: bool = False) -> DataFrame:
    """M24 baseline: predict the train mean for every test day (``compat``:
    the test-window mean, as published — it looks at the answers)."""
    s = chronological_split(series)
    src = s.filter(F.col("split") == ("test" if compat else "train"))
    m = src.agg(F.avg(col).alias("prediction"))
    return s.filter(F.col("split") == "test").crossJoin(F.broadcast(m)).select(DAY, F.col(col).alias("label"),
                                                                               "prediction")


def pivot_counts(df: DataFrame, label: str, prefix: str = "cluster_", distinct_on: str | None = "InvoiceNo") -> DataFrame:
    """Per day × label count of (distinct) invoices, pivoted to
    ``{prefix}{value}`` columns, 0 when absent.  The columns are the labels the
    data holds, in order; a NULL label is the column ``{prefix}none``.  The lines
    are read once: the counts by day and label, few whatever the lines, are a
    written table that both the columns' names and their values come from."""
    day = F.to_date(DAY).alias(DAY)
    cnt = F.countDistinct(distinct_on) if distinct_on else F.count(F.lit(1))
    named = df.withColumn("_label", F.coalesce(F.col(label).cast("string"), F.lit("none")))
    counts = reliable_checkpoint(named.groupBy(day, "_label").agg(cnt.alias("_n"), F.min(label).alias("_first")))
    values = [r[0] for r in counts.groupBy("_label").agg(F.min("_first").alias("_first")).orderBy("_first", "_label").select("_label").collect()]
    p = counts.groupBy(DAY).pivot("_label", values).agg(F.sum("_n"))
    return p.select(DAY, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"{prefix}{v}") for v in values])


def with_label_counts(daily: DataFrame, fact: DataFrame, labels: DataFrame, key: str, label: str, prefix: str = "cluster_") -> DataFrame:
    """J5 + J6: the labels joined to the fact on ``key``, counted by day, and the
    counts joined to the daily frame; a day without labelled invoices has 0."""
    counts = pivot_counts(fact.join(labels.select(key, label), key), label, prefix)
    added = [c for c in counts.columns if c != DAY]
    return daily.join(counts, DAY, "left").select(*daily.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in added])


def minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    from sparkmart.operators.profile import minmax_scale
    return minmax_scale(df, cols, DAY)

