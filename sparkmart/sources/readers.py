"""Readers (S1-S9).  All return lazy DataFrames; pruning and pushdown reach
the file scans because nothing here materialises data."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CLI read-format names → Spark data-source names.
FORMAT_ALIASES = {"txt": "text", "csv": "csv", "json": "json", "parquet": "parquet", "text": "text", "orc": "orc"}


def read_data(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None,
              options: dict | None = None) -> DataFrame:
    """Schema-applied read.  CSV defaults to header=true; pass
    ``{"encoding": "windows-1252"}`` for legacy files.  ``txt`` reads lines
    into the single ``value`` column of the text source; a parquet read with a
    schema yields its columns by name, cast, and NULL where the file has none."""
    src = FORMAT_ALIASES.get(fmt, fmt)
    # a header that differs from the schema is an error, not a silent shift of columns
    opts = {"header": "true", "enforceSchema": "false"} if src == "csv" else {}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    r = spark.read.format(src).options(**opts)
    if schema is None or src == "text":
        return r.load(path)
    if src != "parquet":
        return r.schema(schema).load(path)
    df = r.load(path)
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def read_legacy_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S3: CSV written in the cp1252 code page.  Spark 4 only accepts the
    Unicode / Latin-1 charsets unless the JVM charset table is enabled;
    windows-1252 differs from Latin-1 in 0x80-0x9F (€, curly quotes).

    The setting is needed while the frame runs, so it is not changed here: a
    session without it gets an error that names it."""
    if spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        raise ValueError("cp1252 files need a session with spark.sql.legacy.javaCharsets=true")
    return read_data(spark, path, "csv", schema, {"encoding": "windows-1252"})


def dated_path(template: str, dt: str) -> str:
    """``.../{ds}/file`` style input paths for one execution date."""
    _dt.date.fromisoformat(dt)
    return template.format(ds=dt, dt=dt, yyyy=dt[:4], mm=dt[5:7], dd=dt[8:10])


def read_partition(spark: SparkSession, path: str, dt: str, fmt: str = "parquet") -> DataFrame:
    """S5 on a Hive layout: the filter on ptn_* prunes partitions at planning."""
    d = _dt.date.fromisoformat(dt)
    return (spark.read.format(fmt).load(path)
                 .filter((F.col("ptn_yyyy") == d.year) & (F.col("ptn_mm") == d.month)
                         & (F.col("ptn_dd") == d.day)))


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None, fetch_size: int = 10000,
                 **extra) -> dict:
    """Options for a parallel JDBC extract (one range query per partition).

    Without a partition column the extract is one query on one task, so a
    partition count without a column and bounds is an error."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column or num_partitions is not None or lower is not None or upper is not None:
        if not partition_column or lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    """Database extract (needs the JDBC driver jar on the classpath)."""
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


def read_typed_csv(spark: SparkSession, path: str, ddl: str, header: bool = True) -> DataFrame:
    """Bulk CSV load into a typed schema given as DDL text; a header must name its columns."""
    return (spark.read.schema(ddl).option("header", str(header).lower()).option("enforceSchema", str(not header).lower())
            .option("mode", "PERMISSIVE").csv(path))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs → flat columns named ``a.b.c`` (arrays stay arrays)."""
    def walk(dtype: T.DataType, prefix: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, prefix + [f.name])
        else:
            yield prefix
    cols = []
    for path in walk(df.schema, []):
        ref = F.col(".".join(f"`{p}`" for p in path))
        cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def read_json_flat(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON documents (one per line), flattened."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return flatten(r.json(path))


def run_sql_file(spark: SparkSession, path: str, args: dict | None = None) -> DataFrame:
    """SQL text kept in a file, run with named parameters (``:name``)."""
    text = "\n".join(r.value for r in spark.read.text(path).collect())  # one small text file
    return spark.sql(text, args=args or {})
