import datetime as dt
import decimal
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import clean, pages, profile, series
from sparkmart.sources import readers, writers


def _tmp(prefix):
    return tempfile.mkdtemp(prefix=f"sparkmart-{prefix}-")


def test_readers(spark):
    d = _tmp("read")
    with open(os.path.join(d, "legacy.csv"), "wb") as f:
        f.write("InvoiceNo,Description\n1,CAF\xc9 MUG\n".encode("cp1252"))
    df = readers.read_legacy_csv(spark, os.path.join(d, "legacy.csv"), schema="InvoiceNo string, Description string")
    assert df.first().Description == "CAFÉ MUG"
    with open(os.path.join(d, "lines.txt"), "w") as f:
        f.write("a\nb\n")
    assert readers.read_data(spark, os.path.join(d, "lines.txt"), "txt").count() == 2
    assert readers.dated_path("gs://b/raw/{ds}/file.csv", "2024-11-09") == "gs://b/raw/2024-11-09/file.csv"
    opts = readers.jdbc_options("jdbc:postgresql://h/db", "invoices", "id", 0, 1000, 8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")
    with open(os.path.join(d, "typed.csv"), "w") as f:
        f.write("InvoiceNo,Quantity\n1,5\n2,x\n")
    typed = readers.read_typed_csv(spark, os.path.join(d, "typed.csv"), "InvoiceNo string, Quantity int")
    assert [r.Quantity for r in typed.orderBy("InvoiceNo").collect()] == [5, None]
    with open(os.path.join(d, "tree.json"), "w") as f:
        f.write('{"data": {"shop": {"id": 7, "name": "x"}, "n": 1}}\n')
    flat = readers.read_json_flat(spark, os.path.join(d, "tree.json"))
    assert set(flat.columns) == {"data.shop.id", "data.shop.name", "data.n"}
    spark.range(5).createOrReplaceTempView("nums")
    with open(os.path.join(d, "q.sql"), "w") as f:
        f.write("SELECT count(*) AS n FROM nums\nWHERE id >= :lo")
    assert readers.run_sql_file(spark, os.path.join(d, "q.sql"), {"lo": 2}).first().n == 3


def test_writers_and_partition_read(spark):
    d = _tmp("write")
    df = spark.createDataFrame([(1, 2024, 11, 9, "FR"), (2, 2024, 11, 10, "UK")],
                               "id int, ptn_yyyy int, ptn_mm int, ptn_dd int, country string")
    writers.write_partitioned(df, d + "/silver", ["ptn_yyyy", "ptn_mm", "ptn_dd", "country"])
    assert readers.read_partition(spark, d + "/silver", "2024-11-09").count() == 1
    # dynamic overwrite replaces only touched partitions
    writers.write_partitioned(df.filter("id = 1"), d + "/silver", ["ptn_yyyy", "ptn_mm", "ptn_dd", "country"])
    assert spark.read.parquet(d + "/silver").count() == 2
    p = writers.write_data_product(df, d, "2024-11-09", "customer_profile")
    assert p.endswith("/data/2024-11-09/customer_profile.parquet") and spark.read.parquet(p).count() == 2
    writers.write_json_lines(df, d + "/json")
    assert spark.read.json(d + "/json").count() == 2
    with pytest.raises(RuntimeError):
        writers.write_partitioned(df, d + "/delta", [], fmt="delta")


def test_catalog_sinks(spark):
    d = _tmp("wh")
    df = spark.createDataFrame([("1", 2.5)], "InvoiceNo string, total_spend double")
    name = "sm_clean_" + os.path.basename(d).replace("-", "_")
    writers.replace_table(df, name)
    writers.append_table(df, name)
    assert spark.table(name).count() == 2
    writers.replace_table(df, name)
    assert spark.table(name).count() == 1
    df.write.parquet(d + "/staged")
    writers.external_table(spark, name + "_ext", d + "/staged")
    assert spark.table(name + "_ext").count() == 1
    writers.create_and_load(spark, name + "_typed", "InvoiceNo STRING, total_spend DECIMAL(18,2)", df)
    assert spark.table(name + "_typed").schema["total_spend"].dataType.simpleString() == "decimal(18,2)"
    writers.publish(df, name + "_view")
    assert spark.table(name + "_view").count() == 1


def test_clean_fills_and_mode_ties(spark):
    rows = [("1", "a", None, "2", "12/1/2010 8:26", "1.5", None, "UK"),
            ("2", "a", "x", "1", "12/1/2010 8:26", "2", "17850.0", "UK"),
            ("3", "A", "y", "1", "12/1/2010 8:26", "2", "1.0", "UK"),
            ("4", "b", "z", "1", "bad", "2", "3", "UK")]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in clean.FACT_COLUMNS[:-1]))
    out = {r.InvoiceNo: r for r in clean.clean_transactions(raw).collect()}
    # stock codes upper-cased; "A" group has No Description, x, y once each → tie → smallest text
    assert out["1"].StockCode == "A" and out["1"].Description == "No Description"
    assert out["1"].CustomerID == 0 and out["2"].CustomerID == 17850
    assert out["1"].total_spend == 3.0 and out["4"].InvoiceDate is None


def test_first_last_and_helpers(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "x")], "k int, t int, v string")
    first = {r.k: r.v for r in profile.keep_first_last(df, "k", ["t"]).collect()}
    last = {r.k: r.v for r in profile.keep_first_last(df, "k", ["t"], "last").collect()}
    assert first == {1: "a", 2: "x"} and last == {1: "c", 2: "x"}
    assert profile.drop_incomplete(spark.createDataFrame([(1, None), (2, 3)], "a int, b int")).count() == 1
    assert profile.with_row_id(df).select("row_id").distinct().count() == 3


def test_pages_helpers(spark):
    html = ('<html lang="de"><head><title> Hallo Welt </title><script>var x="<p>no</p>";</script></head>'
            '<body><a href="/x">x</a><a href="https://o.example/y">y</a><a href="z">z</a>'
            '<h1>Hi <b>there</b></h1><p>one</p><p><b>two</b></p></body></html>')
    pg = spark.createDataFrame([(1, "https://shop.example.com/mode/shirt-i.123.456?x=1", html)],
                               "page_id long, url string, html string")
    r = pages.page_records(pg).first()
    assert (r.host, r.level_1, r.level_2, r.level_3) == ("shop.example.com", "mode", "shirt-i.123.456", "")
    assert (r.shop_id, r.product_id, r.lang, r.title, r.title_slug) == ("123", "456", "de", "Hallo Welt", "hallo-welt")
    assert r.h1 == "Hi there" and r.n_links == 3
    links = [x.absolute_url for x in pages.page_links(pg).orderBy("pos").collect()]
    assert links == ["https://shop.example.com/x", "https://o.example/y", "https://shop.example.com/mode/z"]
    paras = [x.text for x in pages.page_paragraphs(pg).orderBy("pos").collect()]
    assert paras[-2:] == ["one", "two"]
    rev = spark.createDataFrame([(1, ["good", "bad"], ["3", "0"])], "product_id long, comments array<string>, likes array<string>")
    z = pages.zip_reviews(rev).orderBy("idx").collect()
    assert [(x.idx, x.comment, x.likes) for x in z] == [(0, "good", "3"), (1, "bad", "0")]
    doc = spark.createDataFrame([('{"data": {"category_list": [{"catid": 11, "name": "Men Clothes", '
                                  '"children": [{"catid": 1}, {"catid": 2}]}]}}',)], "value string")
    urls = [x.url for x in pages.url_frontier(pages.parse_category_tree(doc), "https://s.example", 2).collect()]
    assert len(urls) == 1 + 2 * 2 and "https://s.example/Men-Clothes-cat.11" in urls
    assert "https://s.example/Men-Clothes-cat.11.2?page=1" in urls


def test_series_helpers(spark):
    days = [(dt.date(2024, 1, d), float(d)) for d in range(1, 13)]
    df = spark.createDataFrame(days, "InvoiceDate date, y double")
    hol = spark.createDataFrame([(dt.date(2024, 1, 1),)], "holiday date")
    h = series.add_holidays(df, hol)
    assert h.filter("is_holiday = 1").count() == 1
    lag = {r.InvoiceDate.day: r.y_lag2 for r in series.add_lags(df, {"y": [2]}).collect()}
    assert lag[1] is None and lag[3] == 1.0
    sma = {r.InvoiceDate.day: (r.y_sma3, r.y_lag_sma3)
           for r in series.add_sma(series.add_sma(df, "y", [3]), "y", [3], lagged=True).collect()}
    assert sma[1][0] == 1.0 and sma[6] == (5.0, 2.0)
    folds = series.time_series_folds(df, 3).groupBy("fold", "role").count().collect()
    sizes = {(r.fold, r.role): r["count"] for r in folds}
    assert sizes[(0, "test")] == 3 and sizes[(0, "train")] == 3 and sizes[(2, "train")] == 9
    cal = series.calendar_features(df).filter(F.col("InvoiceDate") == dt.date(2024, 1, 1)).first()
    assert cal.dayofweek == 0 and cal.day_name == "Monday"
    acf = {r.lag: r.acf for r in series.autocorrelation(df, "y", 3).collect()}
    assert acf[0] == 1.0 and acf[1] < 1.0


def test_union_and_pivot(spark):
    from sparkmart.sources.tables import union_all
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 0)], "InvoiceDate timestamp, InvoiceNo long, cluster int")
    b = spark.createDataFrame([(dt.datetime(2024, 1, 1), 2, 1), (dt.datetime(2024, 1, 2), 3, 1)],
                              "InvoiceDate timestamp, InvoiceNo long, cluster int")
    u = union_all([a, b])
    p = {r.InvoiceDate.day: (r.cluster_0, r.cluster_1) for r in series.pivot_counts(u, "cluster").collect()}
    assert p == {1: (1, 1), 2: (0, 1)}
    assert decimal.Decimal("1") == 1


def test_series_key_partitions(spark):
    rows = [("A", dt.datetime(2024, 1, d), 1, "X", "p", decimal.Decimal(d)) for d in range(1, 6)]
    rows += [("B", dt.datetime(2024, 1, d), 2, "Y", "q", decimal.Decimal(10 * d)) for d in range(1, 4)]
    fact = spark.createDataFrame([(c, t, i * 100 + t.day, s, dsc, 1, 1.0, v) for c, t, i, s, dsc, v in rows],
                                 "Country string, InvoiceDate timestamp, InvoiceNo long, StockCode string, "
                                 "Description string, Quantity int, UnitPrice double, total_spend decimal(18,2)")
    daily = series.daily_series(fact, ["Country"])
    assert daily.count() == 8
    lag = series.add_lags(daily.select("Country", series.DAY, "all_sales"), {"all_sales": [1]}, ["Country"])
    firsts = lag.filter(F.col("all_sales_lag1").isNull()).select("Country").collect()
    assert sorted(r.Country for r in firsts) == ["A", "B"]  # each series starts fresh
    folds = series.time_series_folds(daily, 2, ["Country"])
    assert folds.select("Country").distinct().count() == 2


def test_schema_listing(spark):
    from sparkmart.sources.tables import table
    types = profile.schema_listing(table(spark, "/root/testdata/sf0.001", "orders"))
    assert types["o_orderkey"] == "bigint" and types["o_orderdate"] == "timestamp_ntz"


def test_bucketed_table_avoids_shuffle(spark):
    import contextlib
    import io
    name = "sm_bucketed_" + os.path.basename(_tmp("bk")).replace("-", "_")
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("CustomerID"), F.col("id").alias("v"))
    writers.write_bucketed(df, name, 8, ["CustomerID"])
    agg = spark.table(name).groupBy("CustomerID").agg(F.sum("v").alias("s"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        agg.explain()
    assert "Exchange" not in buf.getvalue()
    assert agg.count() == 37
