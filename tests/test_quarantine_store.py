"""Quarantine, duplicates by fingerprint, versions claimed at once, run-owned scratch."""

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from sparkmart.config import parse_config
from sparkmart.operators import ingest, profile
from sparkmart.session import ensure_checkpoint_dir, reliable_checkpoint, run_scratch
from sparkmart.sources import model_store
from sparkmart.sources.bronze import INVOICE_CONFIG


def test_quarantine_keeps_every_row_somewhere(spark, tmp_path):
    cfg = parse_config(INVOICE_CONFIG)
    rows = [("1", "A", None, "3", "1/2/2024 3:04", "1.5", None, "X"), ("2", "A", "t", "n/a", "bad", "1.5", "7", "X"), ("3", None, "t", "1", "1/2/2024 3:04", "free", "7", None)]
    raw = spark.createDataFrame(rows, ingest.source_schema(cfg))
    accepted, rejected, counts = ingest.quarantine(raw, cfg, str(tmp_path / "q"))
    assert counts == {"accepted": 1, "rejected": 2} and accepted.count() == 1 and accepted.first().units == 3
    got = {r.InvoiceNo: r for r in rejected.collect()}
    assert got["2"].reasons == ["units: unreadable", "sold_on: unreadable", "sold_at: unreadable"] and got["2"].Quantity == "n/a"
    assert got["3"].reasons == ["item_code: missing", "list_price: unreadable", "market: missing"]
    empty, none, counts = ingest.quarantine(raw.where("false"), cfg, str(tmp_path / "e"))
    assert counts == {"accepted": 0, "rejected": 0} and empty.count() == 0 == none.count()
    raw.write.option("header", True).csv(str(tmp_path / "raw"))
    out = ingest.run_ingestion(spark, INVOICE_CONFIG, str(tmp_path / "raw"), str(tmp_path / "silver"), "2024-11-09", quarantine_path=str(tmp_path / "kept"))
    assert out.count() == 1 == spark.read.parquet(str(tmp_path / "silver")).count()


def test_duplicates_by_fingerprint(spark):
    rows = [(1, None, "a"), (1, "a", None), (1, None, "a"), (2, "b", "c"), (2, "b", "c"), (2, "b", "c"), (None, None, None), (None, None, None), (3, "z", "z")]
    df = spark.createDataFrame(rows, "n int, `odd.name` string, _fp string").repartition(3)
    got = {tuple(r)[:3]: r.copies for r in profile.duplicate_rows(df).collect()}
    assert got == {(1, None, "a"): 2, (2, "b", "c"): 3, (None, None, None): 2}
    assert tuple(profile.row_counts(df).first()) == (9, 5)
    assert tuple(profile.row_counts(df.where("false")).first()) == (0, 0)


def test_versions_claimed_at_once(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5)
    with ThreadPoolExecutor(4) as pool:
        saved = list(pool.map(lambda i: model_store.save_table_versioned(spark, df.withColumn("i", F.lit(i)), root, "m")[0], range(4)))
    assert sorted(saved) == [1, 2, 3, 4] == model_store.list_versions(spark, root, "m")
    model_store._claim(spark, root, "m")                       # a saver that never finished
    os.makedirs(f"{root}/models/m/v=0005")
    assert model_store.list_versions(spark, root, "m") == [1, 2, 3, 4]
    assert model_store.save_table_versioned(spark, df, root, "m")[0] == 6
    assert model_store.keep_versions(spark, root, "m", 2) == [1, 2, 3] and model_store.list_versions(spark, root, "m") == [4, 6]
    assert model_store.load_latest_table(spark, root, "m").count() == 5


def test_run_scratch_is_removed(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with run_scratch(spark) as path:
        assert reliable_checkpoint(spark.range(3)).count() == 3
        assert len(os.listdir(path.removeprefix("file:"))) == 1
    assert set(os.listdir(root)) == before
