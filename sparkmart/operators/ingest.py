"""Config-driven ingestion: raw all-string table → typed silver table (part A).

``transform`` compiles every column rule into ONE ``select`` (no chain of
``withColumn`` calls, so the analysed plan stays flat); ``enrich`` adds the
de-duplication, the dense surrogate key, the ingestion date and the
partition columns; ``write_silver`` writes it partitioned.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.config import ColumnSpec, TableConfig, parse_config, validate_args
from sparkmart.functions.rules import apply_trims, parse_temporal, typed
from sparkmart.operators.sequence import dense_index

log = logging.getLogger(__name__)

META_COLUMNS = ("_kde_id", "_ingestion_date", "ptn_yyyy", "ptn_mm", "ptn_dd")


def source_schema(cfg: TableConfig) -> T.StructType:
    """Bronze schema: every source column as nullable text, in config order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cfg.source_columns])


def column_expr(spec: ColumnSpec) -> Column:
    """The rules of one column folded into a single expression."""
    c: Column = F.col(spec.source)
    t = spec.spark_type
    is_typed = False  # whether ``c`` already carries the declared type
    for rule in spec.rules:
        for name, arg in rule.items():
            if name == "trim":
                c = apply_trims(c.cast("string") if is_typed else c, arg)
                is_typed = False
            elif name == "format_datetime":
                if t in ("date", "timestamp"):
                    c = parse_temporal(c, arg["source_format"], t)
                    is_typed = True
                else:  # text target: re-format the parsed value
                    fmt = arg.get("target_format") or "yyyy-MM-dd"
                    c = F.date_format(F.try_to_timestamp(c, F.lit(arg["source_format"])), fmt)
            elif name == "round":
                c = F.round(c if is_typed else typed(c, t), int(arg))
                is_typed = True
    if not is_typed:
        c = typed(c, t) if t != "string" else c.cast("string")
    else:
        c = c.cast(t)
    return c.alias(spec.target)


def transform(raw: DataFrame, cfg: TableConfig) -> DataFrame:
    return raw.select(*[column_expr(s) for s in cfg.all_columns])


def deduplicate(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; the kept row is the smallest by the other columns.

    An aggregate (``min`` of a struct) instead of ``row_number`` over a
    window: it combines map-side, so a key repeated a billion times never
    reaches one task as a billion rows.  No keys → rows pass through.
    """
    if not keys:
        log.warning("no primary key: de-duplication skipped")
        return df
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in others])).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def add_surrogate_key(df: DataFrame, order_cols: list[str], name: str = "_kde_id", exchanged: bool = False) -> DataFrame:
    """Dense 1..n key in ``order_cols`` order, without a single-partition exchange."""
    return dense_index(df, order_cols or df.columns, idx_col=name, start=1, exchanged=exchanged)


def partition_columns(df: DataFrame, cfg: TableConfig) -> DataFrame:
    """P10: ptn_yyyy / ptn_mm / ptn_dd from the business date, else the ingestion date."""
    d = cfg.date_partition_column
    base = F.col(d).cast("date") if d else F.col("_ingestion_date")
    return (df.withColumn("ptn_yyyy", F.year(base))
              .withColumn("ptn_mm", F.month(base))
              .withColumn("ptn_dd", F.dayofmonth(base)))


def enrich(typed_df: DataFrame, cfg: TableConfig, dt: str) -> DataFrame:
    df = deduplicate(typed_df, list(cfg.primary_key))
    df = add_surrogate_key(df, list(cfg.primary_key), exchanged=bool(cfg.primary_key))
    df = df.withColumn("_ingestion_date", F.lit(dt).cast("date"))  # P9
    df = partition_columns(df, cfg)
    targets = [c.target for c in cfg.all_columns]
    return df.select("_kde_id", *targets, "_ingestion_date", "ptn_yyyy", "ptn_mm", "ptn_dd")


def silver(raw: DataFrame, cfg, dt: str) -> DataFrame:
    cfg = cfg if isinstance(cfg, TableConfig) else parse_config(cfg)
    dt = validate_args(dt)
    return enrich(transform(raw, cfg), cfg, dt)


def null_violations(typed_df: DataFrame, cfg: TableConfig) -> DataFrame:
    """Q6: per non-nullable column, how many rows are NULL (one aggregate, unpivoted)."""
    strict = [c.target for c in cfg.all_columns if not c.nullable]
    if not strict:
        return typed_df.sparkSession.createDataFrame([], "column string, null_rows bigint")
    agg = typed_df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in strict])
    return agg.unpivot([], strict, "column", "null_rows")


def checked(raw: DataFrame, cfg: TableConfig) -> DataFrame:
    """Q6: the typed columns with ``_reasons``, what is wrong in the columns that must not be
    null ("units: unreadable", "market: missing"), and ``_raw``, the source columns."""
    strict = [c for c in cfg.all_columns if not c.nullable]
    rows = raw.select(*[column_expr(s) for s in cfg.all_columns], F.struct(*[F.col(c) for c in cfg.source_columns]).alias("_raw"))
    why = [F.when(F.col(c.target).isNull(), F.concat(F.lit(f"{c.target}: "), F.when(F.col(f"_raw.{c.source}").isNull(), "missing").otherwise("unreadable")))
           for c in strict]
    return rows.withColumn("_reasons", F.array_compact(F.array(*why)) if why else F.array().cast("array<string>"))


def quarantine(raw: DataFrame, cfg: TableConfig, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Q6/Q7: one write of all rows under ``path``, dealt to the folders ``accepted`` and
    ``rejected``: (accepted typed rows, rejected source rows with ``reasons``, the counts of both,
    observed while writing).  The input is read once; a folder that got no rows reads as empty."""
    seen = Observation()
    bad = F.size("_reasons") > 0
    rows = checked(raw, cfg).observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("rejected"))
    typed_names = [c.target for c in cfg.all_columns]
    out = rows.select(*typed_names, F.when(bad, F.col("_raw")).alias("_raw"), F.when(bad, F.col("_reasons")).alias("_reasons"),
                      F.when(bad, "rejected").otherwise("accepted").alias("_status"))
    out.write.partitionBy("_status").parquet(path)
    counts = seen.get
    log.info("%s: %d rows, %d rejected", cfg.table_name, counts["rows"], counts["rejected"])
    stored = raw.sparkSession.read.schema(out.schema).parquet(path)
    accepted = stored.where("_status = 'accepted'").select(*typed_names)
    rejected = stored.where("_status = 'rejected'").select("_raw.*", F.col("_reasons").alias("reasons"))
    return accepted, rejected, {"accepted": counts["rows"] - counts["rejected"], "rejected": counts["rejected"]}


def read_raw(spark: SparkSession, cfg: TableConfig, path: str, read_format: str = "csv",
             options: dict | None = None) -> DataFrame:
    """Schema-applied read of the raw file (all text, header on by default)."""
    from sparkmart.sources.readers import read_data
    return read_data(spark, path, read_format, source_schema(cfg), options)


def write_silver(df: DataFrame, cfg: TableConfig, path: str, mode: str = "overwrite",
                 fmt: str = "parquet") -> None:
    """K1-K3: partitioned by ptn_yyyy/mm/dd plus the extra configured columns."""
    from sparkmart.sources.writers import write_partitioned
    write_partitioned(df, path, ["ptn_yyyy", "ptn_mm", "ptn_dd", *cfg.extra_partition_columns], mode, fmt)


def run_ingestion(spark: SparkSession, config, input_path: str, output_path: str, dt: str | None = None,
                  read_format: str = "csv", write_format: str = "parquet", mode: str = "overwrite",
                  read_options: dict | None = None, quarantine_path: str | None = None) -> DataFrame:
    """End-to-end entry point (§3.1): validate, read, transform, enrich, write.  With a
    ``quarantine_path`` (a new folder) rows that lack a required value stay there with the
    reasons, and only the others go on."""
    cfg = parse_config(config)
    dt = validate_args(dt, mode, read_format, write_format)
    log.info("ingesting %s from %s (%s) for %s", cfg.table_name, input_path, read_format, dt)
    raw = read_raw(spark, cfg, input_path, read_format, read_options)
    typed_rows = transform(raw, cfg) if quarantine_path is None else quarantine(raw, cfg, quarantine_path)[0]
    out = enrich(typed_rows, cfg, dt)
    write_silver(out, cfg, output_path, mode, write_format)
    return out
