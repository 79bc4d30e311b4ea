"""How often the lines are read and written, and how much a Python task gets at once."""

from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import ingest, series
from sparkmart.plans import registry, segments, timeseries
from sparkmart.session import BATCH_BYTES, ensure_checkpoint_dir, small_batches
from tests.conftest import SF001

_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_label_counts_read_the_lines_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def label(n):
        seen.add(1)
        return "b" if n % 2 else None
    lines = (spark.range(40).select(F.expr("timestamp'2024-01-01' + make_dt_interval(id % 4)").alias("InvoiceDate"), F.col("id").alias("InvoiceNo"))
             .withColumn("label", label.asNondeterministic()("InvoiceNo")))
    got = series.pivot_counts(lines, "label", "n_").orderBy("InvoiceDate").collect()
    assert [(r.n_none, r.n_b) for r in got] == [(10, 0), (0, 10), (10, 0), (0, 10)]
    assert seen.value == 40


def test_the_demand_models_join_the_fact_once(spark, monkeypatch):
    joins, real = [], timeseries.transaction_fact

    def fact_of(*args):
        joins.append(args)
        return real(*args)

    def labelled(spark, sf_dir, fact):
        assert all("sparkmart-" in f for f in fact.inputFiles())      # a written table
        return fact.select("CustomerID").distinct().withColumn("cluster", (F.col("CustomerID") % 3).cast("int"))
    monkeypatch.setattr(timeseries, "transaction_fact", fact_of)
    monkeypatch.setattr(segments, "transaction_fact", fact_of)
    monkeypatch.setattr(segments, "labelled_customers", labelled)
    assert timeseries._clustered_frame(spark, SF001).count()
    assert len(joins) == 1


def test_silver_rows_are_written_once_before_the_store(spark):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("sparkmart-*"))
    registry.queries()["silver_from_csv"](spark, SF001)
    assert len(set(folder.glob("sparkmart-*")) - before) == 1


def test_the_raw_file_and_the_shuffles_of_silver_rows_do_not_stay(spark):
    folder, setting = Path(ensure_checkpoint_dir(spark).removeprefix("file:")), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, raw = spark.conf.get(setting), set(folder.glob("raw-*"))
    found = registry.queries()["silver_from_csv"](spark, SF001)
    assert set(folder.glob("raw-*")) == raw and spark.conf.get(setting) == before
    assert found.count()                                               # the store does not need it


def test_an_exchanged_input_is_indexed_without_a_copy(spark, monkeypatch):
    kept, real = [], DataFrame.persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: (kept.append(1), real(self, *a))[1])
    rows = spark.range(500).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))
    got = ingest.add_surrogate_key(rows, ["k"], exchanged=True).orderBy("k").collect()
    assert [r._kde_id for r in got] == list(range(1, 101)) and not kept


def test_python_tasks_of_the_pipeline_get_small_batches(spark):
    import corpus_pipeline
    before = spark.conf.get(_CONF)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    docs = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("ab cd "), 1000).alias("text"))
    try:
        spark.conf.set(_CONF, str(64 << 20))
        corpus_pipeline.STAGES[3][1](spark, docs.withColumn("n_chars", F.length("text")), SF001)
        assert spark.conf.get(_CONF) == str(BATCH_BYTES)
        small_batches(spark)
        found = [r.n for r in docs.mapInArrow(sizes, "n bigint").collect()]
        assert max(found) < 2 * BATCH_BYTES and sum(found) >= 3000 * 6000
    finally:
        spark.conf.set(_CONF, before)
