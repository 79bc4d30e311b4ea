"""Data profiling, quality probes and report tables (EDA part of D).

Every function returns a small *aggregated* DataFrame (or a filtered one);
all statistics are single distributed aggregates, unpivoted with ``stack``
rather than computed column by column on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sparkmart.functions.columns import money
from sparkmart.operators.quantiles import exact_quantiles
from sparkmart.session import reliable_checkpoint

# Non-product stock codes excluded from basket analysis.
NON_PRODUCT_CODES = ("DOT", "POST", "M", "BANK CHARGES", "D", "CRUK", "B", "S")


def null_profile(df: DataFrame) -> DataFrame:
    """A10: NULL count per column, one row per column."""
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return agg.unpivot([], df.columns, "column", "null_count")


def describe(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Count, mean, std (sample), min, exact quartiles, max per column;
    output one row per column.  Moments come from one aggregate, quartiles
    from the distributed exact quantile (linear interpolation, as pandas)."""
    aggs = []
    types = dict(df.dtypes)
    for c in cols:
        x = F.col(c).cast("double")
        t = types[c]
        if t.startswith("decimal") or t in ("int", "bigint", "smallint", "tinyint"):
            # exact mean for exact types: decimal average, rounded half up below
            scale = int(t.split(",")[1].rstrip(")")) if t.startswith("decimal") else 0
            mean = F.avg(F.col(c).cast(f"decimal(38,{max(scale, 2)})"))
        else:
            mean = F.avg(x)
        aggs += [F.count(x).alias(f"{c}__count"), mean.alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    df = reliable_checkpoint(df.select(*cols))             # read by the moments and by the rank selection
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75], stored=True).select(*[F.col(c).alias(f"{c}__q") for c in cols])
    wide = df.agg(*aggs).crossJoin(qs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                     F.round(F.col(f"{c}__mean"), digits).cast("double").alias("mean"),
                     F.round(F.col(f"{c}__std"), digits).alias("std"),
                     F.col(f"{c}__min").alias("min"),
                     F.round(F.col(f"{c}__q")[0], digits).alias("q25"),
                     F.round(F.col(f"{c}__q")[1], digits).alias("q50"),
                     F.round(F.col(f"{c}__q")[2], digits).alias("q75"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, *cols: str, name: str = "count") -> DataFrame:
    """Rows per value (sorted by count desc, then value)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), *cols))


def sum_by(df: DataFrame, key: Column | str, value: str = "total_spend", alias: str = "total") -> DataFrame:
    """Exact money sum per key."""
    return df.groupBy(key).agg(F.sum(money(value)).cast("double").alias(alias),
                               F.count(F.lit(1)).alias("lines"))


def top_n(df: DataFrame, key: str, value: str, n: int = 10, ascending_after: bool = False) -> DataFrame:
    """The n largest groups by summed value (ties → smallest key), then
    optionally re-sorted ascending for a bar chart.  ``orderBy().limit()``
    plans as TakeOrderedAndProject: each task keeps its own top n only."""
    agg = df.groupBy(key).agg(F.sum(value).alias(f"sum_{value}"))
    top = agg.orderBy(F.col(f"sum_{value}").desc(), F.col(key)).limit(n)
    return top.orderBy(F.col(f"sum_{value}"), F.col(key).desc()) if ascending_after else top


def line_class(qty: str = "Quantity", price: str = "UnitPrice", desc: str = "Description") -> Column:
    """one pass classification of lines with negative quantity."""
    q, p, d = F.col(qty), F.col(price), F.col(desc)
    return (F.when((q < 0) & (d == "Discount"), "discount")
             .when((q < 0) & (p == 0), "free")
             .when((q < 0) & (p > 0), "refund")
             .when(q < 0, "other_negative")
             .otherwise("sale"))


def defects(df: DataFrame) -> DataFrame:
    """negative quantity with zero price."""
    return df.filter((F.col("Quantity") < 0) & (F.col("UnitPrice") == 0))


def quality_probes(raw: DataFrame) -> DataFrame:
    """Regex probes on raw text, one aggregate, unpivoted:
    invoice numbers with a non-digit other than a C/A prefix, quantities with
    a non-digit other than '-', quantities with a dot, customer ids with a
    non-digit."""
    inv = F.regexp_replace(F.col("InvoiceNo"), "^[CA]", "")
    probes = {
        "invoice_no_non_digit": F.regexp_extract(inv, r"\D", 0) != "",
        "quantity_non_digit": F.regexp_extract(F.regexp_replace("Quantity", "-", ""), r"\D", 0) != "",
        "quantity_has_dot": F.col("Quantity").contains("."),
        "customer_id_non_digit": F.regexp_extract(F.col("CustomerID"), r"\D", 0) != "",
        "refund_invoice": F.col("InvoiceNo").startswith("C"),
    }
    agg = raw.agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(k) for k, c in probes.items()])
    return agg.unpivot([], list(probes), "probe", "rows")


def code_length_counts(df: DataFrame, col: str = "StockCode", below: int = 5) -> DataFrame:
    """codes shorter than ``below`` characters and their line counts."""
    return df.filter(F.length(col) < below).groupBy(col).agg(F.count(F.lit(1)).alias("lines"))


def _fingerprinted(df: DataFrame) -> DataFrame:
    """The rows with two 64-bit hashes of all their columns, nulls told apart by place."""
    every = [F.col(f"`{c}`") for c in df.columns] + [F.col(f"`{c}`").isNull() for c in df.columns]
    return df.select("*", F.xxhash64(*every).alias("_fp1"), F.xxhash64(F.lit(17), *every).alias("_fp2"))


def _repeated(df: DataFrame) -> tuple[DataFrame, Observation]:
    """(rows whose fingerprint repeats, counts of all rows and of those that stand alone).

    Only fingerprints are shuffled to be counted; those that repeat are a written
    table, so Spark knows its size when it meets the rows again."""
    seen = Observation()
    counted = (_fingerprinted(df).groupBy("_fp1", "_fp2").agg(F.count(F.lit(1)).alias("_n"))
               .observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.when(F.col("_n") == 1, 1)).alias("alone")))
    again = reliable_checkpoint(counted.where("_n > 1").select("_fp1", "_fp2"))
    return _fingerprinted(df).join(again, ["_fp1", "_fp2"], "left_semi").select(*[F.col(f"`{c}`") for c in df.columns]), seen


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicates with their multiplicity, most repeated first.  Only rows
    whose fingerprint repeats are compared as whole."""
    rows, _ = _repeated(df)
    return (rows.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1).orderBy(F.col("copies").desc()))


def row_counts(df: DataFrame) -> DataFrame:
    """Total rows and distinct rows.  A row whose fingerprint stands alone is
    distinct; the others are compared as whole."""
    rows, seen = _repeated(df)
    found = seen.get
    return rows.distinct().agg((F.count(F.lit(1)) + F.lit(found["alone"])).alias("distinct_rows")).select(
        F.lit(found["rows"]).cast("long").alias("rows"), "distinct_rows")


def iqr_fence(df: DataFrame, col: str, k: float = 1.5, stored: bool = False) -> DataFrame:
    """drop rows at or beyond Q1 - k·IQR / Q3 + k·IQR (exact quartiles).
    The bounds are one aggregate row, broadcast to every partition (J9)."""
    q = exact_quantiles(df, [col], [0.25, 0.75], stored=stored).select(F.col(col).alias("_q"))
    b = q.select((F.col("_q")[0] - k * (F.col("_q")[1] - F.col("_q")[0])).alias("_lo"),
                 (F.col("_q")[1] + k * (F.col("_q")[1] - F.col("_q")[0])).alias("_hi"))
    x = F.col(col)
    return df.crossJoin(F.broadcast(b)).filter((x < F.col("_hi")) & (x > F.col("_lo"))).drop("_lo", "_hi")


def zscore_filter(df: DataFrame, col: str, limit: float = 3.0) -> DataFrame:
    """keep |x - mean| / std_pop < limit; a column without deviation has no outliers."""
    s = df.agg(F.avg(F.col(col).cast("double")).alias("_m"), F.stddev_pop(F.col(col).cast("double")).alias("_s"))
    z = F.abs(F.col(col) - F.col("_m")) / F.when(F.col("_s") != 0, F.col("_s")).otherwise(F.lit(1.0))
    return df.crossJoin(F.broadcast(s)).filter(z < limit).drop("_m", "_s")


def remove_outliers(df: DataFrame, iqr_column: str = "Quantity", zscore_column: str = "UnitPrice") -> DataFrame:
    """F11 then F12 (the z-score is computed on the IQR-filtered rows).  The rows are written
    once: the quartiles, the moments and the filter all read them."""
    return zscore_filter(iqr_fence(reliable_checkpoint(df), iqr_column, stored=True), zscore_column)


def minmax_scale(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """M2: (x - min) / (max - min) per column, bounds broadcast as one row; a
    constant column is 0."""
    b = df.agg(*[F.min(c).alias(f"_mn_{c}") for c in cols], *[F.max(c).alias(f"_mx_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(b))
    def width(c: str) -> Column:
        w = F.col(f"_mx_{c}") - F.col(f"_mn_{c}")
        return F.when(w != 0, w).otherwise(F.lit(1))
    return j.select(key, *[((F.col(c) - F.col(f"_mn_{c}")) / width(c)).alias(c) for c in cols])


def correlation_long(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair, long form, one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(F.col(f"{a}__{b}"), digits).alias("corr"))
            for a, b in pairs]
    return agg.select(F.inline(F.array(*rows)))


def monthly_growth(df: DataFrame, date_col: str = "InvoiceDate", value: str = "total_spend") -> DataFrame:
    """Month-over-month growth (cur - prev) / prev, NULL when prev is 0.

    After the monthly aggregate there is one row per calendar month, so the
    un-partitioned lag window runs over a table bounded by the date range."""
    m = (df.groupBy(F.date_trunc("month", F.col(date_col)).cast("date").alias("month"))
           .agg(F.sum(money(value)).alias("sales")))
    prev = F.lag("sales").over(Window.orderBy("month"))
    return m.select("month", F.col("sales").cast("double").alias("sales"),
                    F.round(F.try_divide(F.col("sales") - prev, F.when(prev != 0, prev)), 6)
                     .cast("double").alias("growth"))


def head_tail(df: DataFrame, order: list[str], n: int, tail: bool = False) -> DataFrame:
    """First / last n rows of a total order (TakeOrderedAndProject)."""
    cols = [F.col(c).desc() if tail else F.col(c).asc() for c in order]
    return df.orderBy(*cols).limit(n)


def schema_listing(df: DataFrame) -> dict[str, str]:
    """Column name → type (metadata only; no data is read)."""
    return dict(df.dtypes)


def keep_first_last(df: DataFrame, key: str, order: list[str], keep: str = "first") -> DataFrame:
    """One row per ``key`` — the first (or last) in ``order``.  An
    aggregate (``min_by`` / ``max_by`` over a struct), so a hot key is
    combined map-side instead of windowed in one task."""
    others = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(c) for c in order])
    pick = F.min_by if keep == "first" else F.max_by
    row = pick(F.struct(*[F.col(c) for c in others]), ordering).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[F.col(f"_row.{c}").alias(c) for c in others])


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """a unique (not consecutive, not stable across re-partitioning) id;
    use ``sequence.dense_index`` when a reproducible 0..n-1 id is needed."""
    return df.withColumn(name, F.monotonically_increasing_id())


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """rows with a NULL in any (of the given) columns removed."""
    return df.na.drop("any", subset=cols)
