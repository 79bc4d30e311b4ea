"""Streaming silver ingestion.

The same rule compiler as the batch path runs on ``readStream``.  Each
micro-batch is de-duplicated on the primary key by the batch operator, loses
the rows whose key the target already holds, and is appended; no row is dropped
for its business date, so a backfill of any age is kept.  Only keys are read
back, and only from the partitions the batch touches where the key contains the
business date.  A batch that is run again after a failure finds its own rows in
the target and adds nothing twice.

The dense 1..n key (a global ranking) becomes a 64-bit hash of the key.

``trigger(availableNow=True)`` processes everything present and stops, which
is how a daily schedule runs it; a continuous deployment uses
``processingTime`` instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmart.config import TableConfig, parse_config, validate_args
from sparkmart.operators.ingest import deduplicate, partition_columns, source_schema, transform
from sparkmart.sources.readers import FORMAT_ALIASES

PARTS = ["ptn_yyyy", "ptn_mm", "ptn_dd"]


def silver_stream(spark: SparkSession, config, input_dir: str, dt: str | None = None, read_format: str = "csv",
                  options: dict | None = None) -> DataFrame:
    """The streaming silver DataFrame (not started, repeated keys still in it)."""
    cfg = config if isinstance(config, TableConfig) else parse_config(config)
    dt = validate_args(dt, read_format=read_format)
    fmt = FORMAT_ALIASES.get(read_format, read_format)
    reader = spark.readStream.schema(source_schema(cfg)).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    for k, v in (options or {}).items():
        reader = reader.option(k, str(v))
    typed = transform(reader.load(input_dir), cfg)
    targets = [c.target for c in cfg.all_columns]
    keyed = typed.withColumn("_kde_id", F.xxhash64(*[F.col(c) for c in (cfg.primary_key or targets)]))
    keyed = keyed.withColumn("_ingestion_date", F.lit(dt).cast("date"))
    return partition_columns(keyed, cfg).select("_kde_id", *targets, "_ingestion_date", *PARTS)


def _same(columns: list[str]):
    return reduce(lambda a, b: a & b, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in columns])


def new_rows(batch: DataFrame, cfg: TableConfig, output_path: str) -> DataFrame:
    """The batch's rows, one per key, whose key the target does not hold yet."""
    pk = list(cfg.primary_key)
    if not pk:
        return batch
    rows = deduplicate(batch, pk)
    try:
        target = batch.sparkSession.read.schema(batch.schema).parquet(output_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return rows
    known = target.alias("old")
    if cfg.date_partition_column in pk:
        known = known.join(rows.select(*PARTS).distinct().alias("new"), _same(PARTS), "left_semi").alias("old")
    return rows.alias("new").join(known.select(*[F.col(f"old.{c}") for c in pk]).alias("old"), _same(pk), "left_anti")


def start_silver_stream(spark: SparkSession, config, input_dir: str, output_path: str, checkpoint_location: str,
                        dt: str | None = None, read_format: str = "csv", available_now: bool = True,
                        processing_time: str | None = None, options: dict | None = None) -> StreamingQuery:
    cfg = config if isinstance(config, TableConfig) else parse_config(config)
    df = silver_stream(spark, cfg, input_dir, dt, read_format, options)

    def append(batch: DataFrame, batch_id: int) -> None:
        if not cfg.primary_key:      # nothing tells a row from one that a first, lost run of this batch wrote: replace that run's folders
            (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*PARTS, *cfg.extra_partition_columns, "_batch").parquet(output_path))
            return
        (new_rows(batch, cfg, output_path).write.mode("append")
         .partitionBy(*PARTS, *cfg.extra_partition_columns).parquet(output_path))

    w = df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
