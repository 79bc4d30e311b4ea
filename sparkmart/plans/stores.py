"""Queries that write given tables through a sink and read them back through a
source.  Files go to a folder of their own under the checkpoint folder, catalog
tables get a name of their own and are dropped once their rows are copied."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from sparkmart.config import parse_config
from sparkmart.operators import ingest, interpret, pages, profile, series
from sparkmart.plans.ingestion import _COLUMNS, _DEDUP_CTE, _PK, _TYPED_SQL, DT
from sparkmart.plans.registry import register
from sparkmart.plans.sqltext import with_fact
from sparkmart.session import ensure_checkpoint_dir, remove_folder, shuffles_removed
from sparkmart.sources import readers, writers
from sparkmart.sources.bronze import INVOICE_CONFIG, RAW_SQL, raw_invoices
from sparkmart.sources.tables import register_views, table, transaction_fact, union_all

LATER = "2024-11-10"
RELOADED_YEAR = 1997
ORDER_DAY = "1998-10-03"
ZIPPED_ROWS = 1 << 20                # lines of a gzip file, which one task reads whole
# Text files must not lose the padding that the raw codes carry.
KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _staged_csv(spark, df, name, **options):
    path = _folder(spark, name)
    df.write.options(header="true", **KEEP_SPACES, **options).csv(path)
    return path


_LOADED_SQL = _TYPED_SQL + _DEDUP_CTE + f"""
SELECT row_number() OVER (ORDER BY {_PK}) AS _kde_id, {_COLUMNS},
       CASE WHEN year(sold_on) = {RELOADED_YEAR} THEN DATE '{LATER}' ELSE DATE '{DT}' END AS _ingestion_date,
       CAST(year(sold_on) AS INTEGER) AS ptn_yyyy, CAST(month(sold_on) AS INTEGER) AS ptn_mm,
       CAST(day(sold_on) AS INTEGER) AS ptn_dd
FROM dedup
"""


@register("silver_from_csv", oracle=_LOADED_SQL, covers=("S1", "S2", "K1", "K2", "K3"))
def silver_from_csv(spark, sf_dir):
    """Raw CSV file → config-driven read → silver rows partitioned by year and
    the configured extra columns; one year is loaded again a day later, which
    replaces its partitions and no others."""
    cfg = parse_config(INVOICE_CONFIG)
    with shuffles_removed(spark):
        raw = _staged_csv(spark, raw_invoices(spark, sf_dir), "raw", compression="gzip", maxRecordsPerFile=ZIPPED_ROWS)
        out = ingest.silver(ingest.read_raw(spark, cfg, raw, "csv"), cfg, DT)      # the key's index has written its rows
        remove_folder(spark, raw)
        store, parts = _folder(spark, "silver"), ["ptn_yyyy", *cfg.extra_partition_columns]
        writers.write_partitioned(out, store, parts)
        again = out.where(F.col("ptn_yyyy") == RELOADED_YEAR).withColumn("_ingestion_date", F.lit(LATER).cast("date"))
        writers.write_partitioned(again, store, parts)
    return spark.read.parquet(store).select(*out.columns)


_DAY_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS ptn_yyyy,
       CAST(month(o_orderdate) AS INTEGER) AS ptn_mm, CAST(day(o_orderdate) AS INTEGER) AS ptn_dd
FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '{ORDER_DAY}'"""


@register("orders_of_day", oracle=_DAY_SQL, covers=("S5",))
def orders_of_day(spark, sf_dir):
    """All orders stored by day under a dated path, one day's partition read back."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("ptn_yyyy"),
        F.month("o_orderdate").alias("ptn_mm"), F.dayofmonth("o_orderdate").alias("ptn_dd"))
    store = readers.dated_path(_folder(spark, "orders") + "/load_date={ds}", DT)
    writers.write_partitioned(orders, store, ["ptn_yyyy", "ptn_mm", "ptn_dd"])
    return readers.read_partition(spark, store, ORDER_DAY)


_LEGACY_SQL = """
SELECT c_custkey, '“' || c_mktsegment || '” – ' || CAST(c_custkey AS VARCHAR) || ' €' AS note, c_name FROM customer"""


@register("legacy_customers", oracle=_LEGACY_SQL, covers=("S3",))
def legacy_customers(spark, sf_dir):
    """Customers with a note in characters that only cp1252 places at 0x80-0x9F,
    written in that code page and read back.  The charset setting belongs to a
    session of its own, the caller's keeps its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.legacy.javaCharsets", "true")
    note = F.concat(F.lit("“"), "c_mktsegment", F.lit("” – "), F.col("c_custkey").cast("string"), F.lit(" €"))
    src = table(own, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_name")
    path = _staged_csv(own, src, "legacy", encoding="windows-1252")
    back = _folder(spark, "legacy-read")
    readers.read_legacy_csv(own, path, "c_custkey bigint, note string, c_name string").write.parquet(back)
    return spark.read.parquet(back)


_BULK_DDL = ("InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, "
             "UnitPrice double, CustomerID double, Country string")
_BULK_SQL = f"""
WITH raw AS ({RAW_SQL})
SELECT InvoiceNo, StockCode, Description,
       CASE WHEN regexp_full_match(Quantity, '-?[0-9]+') THEN CAST(Quantity AS INTEGER) END AS Quantity, InvoiceDate,
       TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice, TRY_CAST(CustomerID AS DOUBLE) AS CustomerID, Country
FROM raw"""


@register("bulk_csv_load", oracle=_BULK_SQL, covers=("S7",))
def bulk_csv_load(spark, sf_dir):
    """The raw invoice file loaded into a typed schema; values that do not fit are NULL."""
    return readers.read_typed_csv(spark, _staged_csv(spark, raw_invoices(spark, sf_dir), "bulk"), _BULK_DDL)


_FILE_QUERY = """SELECT o_custkey, count(*) AS n_orders, max(o_orderkey) AS last_order
FROM orders
WHERE o_orderstatus = :status
GROUP BY o_custkey
HAVING count(*) >= :least"""


@register("orders_by_sql_file", oracle=_FILE_QUERY.replace(":status", "'F'").replace(":least", "2"), covers=("S9",))
def orders_by_sql_file(spark, sf_dir):
    """A query kept in a file, run with named parameters; the views it names
    belong to a session of its own."""
    own = spark.newSession()
    register_views(own, sf_dir, ("orders",))
    path, back = _folder(spark, "query"), _folder(spark, "query-result")
    own.createDataFrame([(_FILE_QUERY,)], "value string").write.text(path)
    readers.run_sql_file(own, path, {"status": "F", "least": 2}).write.parquet(back)
    return spark.read.parquet(back)


_PRODUCT_SQL = with_fact("SELECT Country, CAST(sum(total_spend) AS DOUBLE) AS total_spend FROM fact GROUP BY Country")


@register("country_product", oracle=_PRODUCT_SQL, covers=("K4",))
def country_product(spark, sf_dir):
    """Sales by country as a dated data product, read back from its path."""
    sales = transaction_fact(spark, sf_dir).groupBy("Country").agg(F.sum("total_spend").cast("double").alias("total_spend"))
    return spark.read.parquet(writers.write_data_product(sales, _folder(spark, "products"), DT, "sales_by_country"))


_JSON_SQL = """
SELECT c_custkey AS custkey, c_name AS "place.name", c_nationkey AS "place.nation", c_mktsegment AS "place.market.segment"
FROM customer"""


@register("customers_as_json", oracle=_JSON_SQL, covers=("K13", "S8"))
def customers_as_json(spark, sf_dir):
    """Customers as nested JSON documents, one a line, read back flat."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                 F.struct(F.col("c_mktsegment").alias("segment")).alias("market")).alias("place"))
    path = _folder(spark, "json")
    writers.write_json_lines(c, path)
    return readers.read_json_flat(spark, path, c.schema)


@contextmanager
def _own_table(spark, name):
    full = f"{name}_{uuid.uuid4().hex}"
    try:
        yield full
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {full}")


_LOADS = ("replaced", "appended", "external", "loaded", "published", "viewed")
_LOADS_SQL = " UNION ALL ".join(
    f"SELECT '{way}' AS via, c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer" for way in _LOADS)


@register("catalog_loads", oracle=_LOADS_SQL, covers=("K8", "K9", "K10", "K11", "K12", "U1"))
def catalog_loads(spark, sf_dir):
    """Customers through each kind of catalog load: a table replaced after a
    partial load, one filled by two appends, an external table over staged files,
    a declared table that casts its source, and a published table and view."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    even = F.col("c_custkey") % 2 == 0
    own = spark.newSession()                     # the view stays out of the caller's session
    found = []

    def copy(way, df):
        path = _folder(spark, f"load-{way}")
        df.select(F.lit(way).alias("via"), F.col("c_custkey").cast("bigint").alias("c_custkey"),
                  F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_mktsegment").write.parquet(path)
        found.append(spark.read.parquet(path))

    with _own_table(spark, "replaced") as t:
        writers.replace_table(c.where(even), t)
        writers.replace_table(c, t)
        copy("replaced", spark.table(t))
    with _own_table(spark, "appended") as t:
        writers.append_table(c.where(even), t)
        writers.append_table(c.where(~even), t)
        copy("appended", spark.table(t))
    with _own_table(spark, "external") as t:
        staged = _folder(spark, "staged")
        c.write.parquet(staged)
        copy("external", writers.external_table(spark, t, staged))
    with _own_table(spark, "loaded") as t:
        writers.create_and_load(spark, t, "c_mktsegment string, c_custkey string, c_nationkey smallint", c)
        copy("loaded", spark.table(t))
    with _own_table(spark, "published") as t:
        writers.publish(c, t, materialize=True)
        copy("published", spark.table(t))
    writers.publish(table(own, sf_dir, "customer"), "published_customers")
    copy("viewed", own.table("published_customers"))
    return union_all(found)


_REVIEWS_SQL = """
WITH lists AS (
  SELECT o_orderkey, 1 + o_orderkey % 3 AS n_comments, 1 + o_custkey % 4 AS n_likes, o_custkey FROM orders)
SELECT o_orderkey, CAST(i AS INTEGER) AS idx,
       CASE WHEN i < n_comments THEN CAST(o_orderkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) END AS comment,
       CASE WHEN i < n_likes THEN o_custkey + i END AS likes
FROM lists, unnest(range(greatest(n_comments, n_likes))) AS u(i)"""


@register("order_reviews", oracle=_REVIEWS_SQL, covers=("X15",))
def order_reviews(spark, sf_dir):
    """Two parallel lists of different lengths an order, zipped to rows."""
    lists = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("transform(sequence(0, o_orderkey % 3), i -> concat(o_orderkey, '-', i))").alias("comments"),
        F.expr("transform(sequence(0, o_custkey % 4), i -> o_custkey + i)").alias("likes"))
    return pages.zip_reviews(lists)


_HOLIDAY_SQL = with_fact("""
SELECT DISTINCT CAST(InvoiceDate AS DATE) AS InvoiceDate,
       CASE WHEN day(InvoiceDate) = 1 OR (month(InvoiceDate) = 12 AND day(InvoiceDate) >= 25) THEN 1 ELSE 0 END AS is_holiday
FROM fact""")


def holiday_calendar(spark, sf_dir):
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderdate").where(
        (F.dayofmonth(day) == 1) | ((F.month(day) == 12) & (F.dayofmonth(day) >= 25)))


@register("holiday_flags", oracle=_HOLIDAY_SQL, covers=("J7",))
def holiday_flags(spark, sf_dir):
    """Invoice days flagged by a calendar taken from the order dates: first days
    of a month and the last week of a year, listed once an order."""
    days = transaction_fact(spark, sf_dir).select(F.to_date("InvoiceDate").alias(series.DAY)).distinct()
    return series.add_holidays(days, holiday_calendar(spark, sf_dir))


_UNRETURNED_SQL = with_fact("""
SELECT CustomerID FROM fact GROUP BY CustomerID HAVING count(*) FILTER (WHERE Quantity < 0) = 0""")


@register("customers_without_returns", oracle=_UNRETURNED_SQL, covers=("U2",))
def customers_without_returns(spark, sf_dir):
    """Customers with no row among the returned lines."""
    fact = transaction_fact(spark, sf_dir)
    return interpret.unexplained_groups(fact, fact.where("Quantity < 0"), "CustomerID")


@register("row_id_counts", oracle=with_fact("SELECT count(*) AS n_rows, count(*) AS n_ids FROM fact"), covers=("F13",))
def row_id_counts(spark, sf_dir):
    """Rows of the fact and distinct row ids given to them."""
    return profile.with_row_id(transaction_fact(spark, sf_dir)).agg(
        F.count("*").alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))
