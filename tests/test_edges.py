"""Edge cases: constant columns, NULLs, labels and paragraphs the data brings, settings left alone."""

import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import basket, pages, profile, quantiles, segment, series
from sparkmart.sources import readers


def test_constant_columns(spark):
    df = spark.createDataFrame([(i, 5.0, float(i)) for i in range(4)], "CustomerID int, c double, x double")
    scaled = {r.CustomerID: (r.c, r.x) for r in profile.minmax_scale(df, ["c", "x"], "CustomerID").collect()}
    assert scaled[0] == (0.0, 0.0) and scaled[3] == (0.0, 1.0)
    assert profile.zscore_filter(df, "c").count() == 4
    days = spark.createDataFrame([(dt.date(2024, 1, d), 2.0) for d in range(1, 6)], "InvoiceDate date, y double")
    assert {r.acf for r in series.autocorrelation(days, "y", 2).collect()} == {None}


def test_silhouette_of_a_single_member(spark):
    rows = [(1, 0, 0.0), (2, 0, 1.0), (3, 1, 9.0)]
    pred = spark.createDataFrame(rows, "CustomerID int, cluster int, x double")
    s = {r.CustomerID: r.silhouette for r in segment.silhouette_per_sample(pred, cols=("x",)).collect()}
    assert s[3] == 0.0 and s[1] == pytest.approx((81 - 1) / 81)


def test_market_lines_keep_nulls(spark):
    rows = [("POST", 1.0), (None, 1.0), ("A", None), ("A", -1.0), ("A", 2.0)]
    df = spark.createDataFrame(rows, "StockCode string, total_spend double")
    assert sorted(map(str, basket.market_lines(df).collect())) == sorted(map(str, df.where("StockCode IS NULL OR (StockCode = 'A' AND (total_spend IS NULL OR total_spend > 0))").collect()))


def test_labels_come_from_the_data(spark):
    fact = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 7), (dt.date(2024, 1, 1), 2, 8), (dt.date(2024, 1, 2), 3, 9)],
                                 "InvoiceDate date, InvoiceNo int, CustomerID int")
    labels = spark.createDataFrame([(7, "new"), (8, None)], "CustomerID int, segment string")
    daily = spark.createDataFrame([(dt.date(2024, 1, d), 1.0) for d in (1, 2, 3)], "InvoiceDate date, total double")
    got = series.with_label_counts(daily, fact, labels, "CustomerID", "segment", "n_").orderBy("InvoiceDate").collect()
    assert [(r.n_none, r.n_new) for r in got] == [(1, 1), (0, 0), (0, 0)]


def test_open_paragraphs(spark):
    html = "<div><p>one<p class='x'>two <b>bold</b><div>out</div><P>three</p>rest<style><p>no</style><p>four"
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    assert [r.text for r in pages.page_paragraphs(df).orderBy("pos").collect()] == ["one", "two bold", "three", "four"]


def test_links_of_all_kinds(spark):
    html = """<a href="mailto:a@b.c"><a href='#x'><a href="?q=1"><a href='img/y.png'><a href="/z">"""
    df = spark.createDataFrame([(1, "https://a.example/d/e?f#g", html)], "page_id int, url string, html string")
    assert [r.absolute_url for r in pages.page_links(df).orderBy("pos").collect()] == [
        "mailto:a@b.c", "https://a.example/d/e?f#x", "https://a.example/d/e?q=1", "https://a.example/d/img/y.png", "https://a.example/z"]


def test_quantiles_of_repeated_values(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 1.0, 1.0, 2.0, 10.0)] + [("b", None), ("b", 4.0), (None, 3.0)], "g string, x double")
    got = {r.g: r.x for r in quantiles.exact_quantiles(df, ["x"], [0.0, 0.5, 0.9, 1.0], ["g"]).collect()}
    assert got["a"] == pytest.approx([1.0, 1.0, 6.8, 10.0]) and got["b"] == [4.0] * 4 and got[None] == [3.0] * 4
    assert quantiles.exact_quantiles(df.where("false"), ["x"], [0.5]).first().x is None


def test_spectrum_of_a_sine(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(d), math.sin(2 * math.pi * d / 7)) for d in range(70)]
    top = series.spectrum(spark.createDataFrame(days, "InvoiceDate date, y double"), "y", 1).first()
    assert (top.rank, top.k, top.period, top.amplitude) == (1, 10, 7.0, 35.0)


def test_reader_settings(spark):
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", num_partitions=8)
    path = tempfile.mkdtemp() + "/t"
    spark.range(2).select(F.col("id").alias("a"), F.lit("5").alias("b")).write.parquet(path)
    got = readers.read_data(spark, path, "parquet", "b int, c string")
    assert got.dtypes == [("b", "int"), ("c", "string")] and got.first().b == 5
