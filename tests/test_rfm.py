import datetime as dt

from pyspark.sql import functions as F

from sparkmart.operators.rfm import customer_profile
from sparkmart.operators.sequence import dense_index, previous_rows


def _fact(spark, rows):
    schema = ("InvoiceNo long, StockCode string, Description string, Quantity int, InvoiceDate timestamp, "
              "UnitPrice double, CustomerID long, Country string, total_spend decimal(18,2)")
    return spark.createDataFrame(rows, schema)


def d(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_profile_edge_cases(spark):
    import decimal as D
    m = lambda x: D.Decimal(str(x))
    rows = [
        # customer 1: one invoice
        (1, "A", "a", 2, d(5), 1.0, 1, "X", m(2.00)),
        # customer 2: two invoices -> interval falls back to recency
        (2, "A", "a", 1, d(1), 1.0, 2, "X", m(1.00)),
        (3, "B", "b", 3, d(4), 1.0, 2, "X", m(3.00)),
        # customer 3: four invoices, two on one timestamp, gaps 0, 2, 5
        (4, "A", "a", 1, d(1), 1.0, 3, "X", m(1.00)),
        (5, "A", "a", 1, d(1), 1.0, 3, "X", m(1.00)),
        (6, "A", "a", 1, d(3), 1.0, 3, "X", m(1.00)),
        (6, "B", "b", 1, d(3), 1.0, 3, "X", m(2.25)),
        (7, "A", "a", 1, d(8), 1.0, 3, "X", m(1.00)),
        # anonymous is dropped
        (8, "A", "a", 1, d(9), 1.0, 0, "X", m(9.00)),
    ]
    out = {r.CustomerID: r for r in customer_profile(_fact(spark, rows)).collect()}
    assert set(out) == {1, 2, 3}
    # latest invoice date among known customers is day 8
    assert out[1].recency == 3 and out[1].frequency == 1 and out[1].is_first_time_buyer == 1
    assert out[1].mean_time_interval == 3.0
    assert out[2].recency == 3 and out[2].mean_time_interval == 3.0
    # gaps for customer 3: [None, 0, 2, 5] -> |2-0|, |5-2| -> mean 2.5
    assert out[3].recency == 5 and out[3].mean_time_interval == 2.5
    assert out[3].frequency == 4 and out[3].monetary == 6.25
    # invoice 6 has two stock codes -> (1+1+2+1)/4
    assert out[3].mean_unique_item == 1.25
    # half-up on the exact value: 6.25 / 4 = 1.5625 -> 1.56
    assert out[3].mean_ticket_size == 1.56
    compat = {r.CustomerID: r for r in customer_profile(_fact(spark, rows), compat=True).collect()}
    assert compat[1].is_first_time_buyer == 0


def test_profile_invoice_across_months(spark):
    """The profile rolls invoices and months up from one (customer, invoice,
    month, stock code) table: a stock code bought in two months of one
    invoice still counts once for the invoice, and the invoice counts in
    both months."""
    import decimal as D
    m = lambda x: D.Decimal(str(x))
    jan, feb = dt.datetime(2024, 1, 31, 23), dt.datetime(2024, 2, 1, 1)
    rows = [
        (1, "A", "a", 2, jan, 1.0, 7, "X", m(2.00)),
        (1, "A", "a", 1, feb, 1.0, 7, "X", m(1.00)),
        (1, "B", "b", 3, feb, 1.0, 7, "X", m(3.00)),
        (2, "A", "a", 1, dt.datetime(2024, 2, 10), 1.0, 7, "X", m(4.00)),
    ]
    got = customer_profile(_fact(spark, rows)).collect()[0]
    assert got.frequency == 2 and got.monetary == 10.0
    # invoice 1 has distinct codes {A, B}; invoice 2 has {A}
    assert got.mean_unique_item == 1.5
    assert got.mean_quantity == 3.5 and got.mean_ticket_size == 5.0
    # January: 1 invoice, mean line 2.00; February: 2 invoices, mean (1+3+4)/3
    assert got.freq_per_month == 1.5
    assert got.mean_spent_per_month == round((2.0 + 8 / 3) / 2, 2)

def test_dense_index_is_consecutive(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") % 7)).withColumn("v", F.col("id") * 3)
    idx = dense_index(df, ["k", "v"], num_partitions=6)
    got = idx.orderBy("k", "v").select("_seq_idx").collect()
    assert [r[0] for r in got] == list(range(5000))
    lagged = previous_rows(idx, ["k"], ["v"], [1, 2])
    first = lagged.filter(F.col("v_lag1").isNull()).count()
    assert first == 7  # one per key
    bad = lagged.filter(F.col("v_lag1").isNotNull() & (F.col("v") - F.col("v_lag1") != 21)).count()
    assert bad == 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns[0] == "CustomerID"
    assert df.count() > 0


def test_previous_rows_across_blocks(spark, monkeypatch):
    from sparkmart.operators import sequence
    monkeypatch.setattr(sequence, "BLOCK", 4)
    rows = spark.createDataFrame([("a" if i < 10 else "b", i, i * i) for i in range(23)], "k string, i long, v long")
    for start in (0, 1):
        got = {r["i"]: r for r in previous_rows(dense_index(rows, ["k", "i"], start=start), ["k"], ["i", "v"], [1, 3]).collect()}
        assert len(got) == 23
        for i, r in got.items():
            first = 0 if i < 10 else 10
            for lag in (1, 3):
                j = i - lag
                assert (r[f"i_lag{lag}"], r[f"v_lag{lag}"]) == ((j, j * j) if j >= first else (None, None))


def test_profile_writes_no_table_of_lines(spark, monkeypatch):
    """What is written is a row for each invoice and month; codes of invoices of several months,
    null codes and null invoices count as before."""
    import decimal as D
    from sparkmart.operators import rfm
    written = []

    def kept(df):
        written.append(df.count())
        return df
    monkeypatch.setattr(rfm, "reliable_checkpoint", kept)
    later = dt.datetime(2024, 2, 3)
    rows = [(1, code, "x", 1, d(3), 1.0, 1, "X", D.Decimal("1.50")) for code in "AABBCC"]
    rows += [(2, code, "x", 1, when, 1.0, 1, "X", D.Decimal("2.00")) for code in ("A", "B", None) for when in (d(9), later)]
    rows += [(None, "A", "x", 1, d(2), 1.0, 2, "X", D.Decimal("1.00")), (5, None, "x", 1, d(2), 1.0, 2, "X", D.Decimal("1.00"))]
    got = {r.CustomerID: r for r in rfm.customer_profile(_fact(spark, rows)).collect()}
    assert max(written) == 5
    assert got[1].frequency == 2 and got[1].mean_unique_item == 2.5 and got[1].mean_quantity == 6.0
    assert got[1].freq_per_month == 1.5 and got[1].mean_spent_per_month == round((15 / 9 + 2) / 2, 2)
    assert got[2].mean_unique_item == 0.5 and got[2].freq_per_month == 1.0
