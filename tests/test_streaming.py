import os
import tempfile

from sparkmart.sources.bronze import INVOICE_CONFIG
from sparkmart.streaming.ingest_stream import start_silver_stream

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def _write(path, lines):
    with open(path, "w") as f:
        f.write(HEADER + "".join(line + "\n" for line in lines))


def test_stream_dedup_and_partitions(spark):
    root = tempfile.mkdtemp(prefix="sparkmart-stream-")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    _write(os.path.join(src, "a.csv"), [
        "536365,85123A,WHITE HANGING,6,12/1/2010 8:26,2.55,17850.0,United Kingdom",
        "536365,85123A,WHITE HANGING,6,12/1/2010 8:26,2.55,17850.0,United Kingdom",
        "536366,22633,HAND WARMER,6,12/2/2010 8:28,1.85,17850.0,France",
    ])
    q = start_silver_stream(spark, INVOICE_CONFIG, src, out, ck, dt="2024-11-09")
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    # a later file repeating a key inside the watermark adds nothing for it
    _write(os.path.join(src, "b.csv"), [
        "536365,85123A,WHITE HANGING,6,12/1/2010 8:26,2.55,17850.0,United Kingdom",
        "536367,84879,BIRD ORNAMENT,32,12/2/2010 9:00,1.69,13047.0,United Kingdom",
    ])
    q = start_silver_stream(spark, INVOICE_CONFIG, src, out, ck, dt="2024-11-09")
    q.awaitTermination(120)
    back = spark.read.parquet(out)
    assert back.count() == 3
    assert {r.market for r in back.select("market").distinct().collect()} == {"United Kingdom", "France"}
    assert back.select("_kde_id").distinct().count() == 3


def test_late_rows_are_kept(spark):
    """A backfill older than anything seen is appended; no row goes for its date."""
    root = tempfile.mkdtemp(prefix="sparkmart-late-")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    line = "{},22633,HAND WARMER,6,{} 8:28,1.85,17850.0,France"
    _write(os.path.join(src, "a.csv"), [line.format(1, "3/10/2024"), line.format(2, "3/11/2024")])
    start_silver_stream(spark, INVOICE_CONFIG, src, out, ck, dt="2024-11-09").awaitTermination(120)
    _write(os.path.join(src, "b.csv"), [line.format(3, "3/12/2024"), line.format(4, "1/5/2024"), line.format(5, "12/31/2023"),
                                        line.format(1, "3/10/2024"), line.format(6, "not a date")])
    start_silver_stream(spark, INVOICE_CONFIG, src, out, ck, dt="2024-11-09").awaitTermination(120)
    assert sorted(r.document for r in spark.read.parquet(out).select("document").collect()) == list("123456")


def test_a_keyless_batch_that_runs_again_adds_nothing(spark):
    root = tempfile.mkdtemp(prefix="sparkmart-keyless-")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    line = "{},22633,HAND WARMER,6,3/10/2024 8:28,1.85,17850.0,France"
    config = {**INVOICE_CONFIG, "primary_key": []}
    _write(os.path.join(src, "a.csv"), [line.format(1), line.format(1), line.format(2)])
    start_silver_stream(spark, config, src, out, ck, dt="2024-11-09").awaitTermination(120)
    for f in os.listdir(os.path.join(ck, "commits")):      # the driver is lost after the write, before the commit
        os.remove(os.path.join(ck, "commits", f))
    start_silver_stream(spark, config, src, out, ck, dt="2024-11-09").awaitTermination(120)
    assert sorted(r.document for r in spark.read.parquet(out).collect()) == ["1", "1", "2"]
    _write(os.path.join(src, "b.csv"), [line.format(1)])
    start_silver_stream(spark, config, src, out, ck, dt="2024-11-09").awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
