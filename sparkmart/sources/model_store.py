"""Versioned Spark ML model store and the per-run control file.

Layout: ``{root}/models/{name}/v={n:04d}`` (Spark ML persistence, never
pickle); the latest version is the numerically largest published ``n`` (so v=10
beats v=9).  A saver first claims a number by a file that only one can create,
then writes the version and last puts the mark ``_PUBLISHED`` into it, so two savers
at once get two versions and nobody reads half of one.  Listing goes through the Hadoop FileSystem of the path, so the same
code works on local disk, HDFS and object stores.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"^v=(\d+)$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def model_dir(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/models/{name}"


def _numbers(spark: SparkSession, path: str) -> dict[int, str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {int(m.group(1)): st.getPath().toString() for st in fs.listStatus(p) if (m := _VERSION.match(st.getPath().getName()))}


def list_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """The published versions, and those that were stored before numbers were claimed."""
    claimed = _numbers(spark, f"{model_dir(root, name)}/_claims")
    fs, _ = _fs(spark, root)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n, path in _numbers(spark, model_dir(root, name)).items() if n not in claimed or fs.exists(mark(f"{path}/_PUBLISHED")))


def _claim(spark: SparkSession, root: str, name: str) -> int:
    """The next number that nobody has claimed; the claim is a file created exclusively,
    which holds its owner's token."""
    claims, token = f"{model_dir(root, name)}/_claims", uuid.uuid4().hex
    fs, _ = _fs(spark, claims)
    while True:
        n = max([0, *_numbers(spark, claims), *_numbers(spark, model_dir(root, name))]) + 1
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{claims}/v={n:04d}")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            continue
        out.write(bytearray(token.encode()))
        out.close()
        held = fs.open(path)
        mine = bytes(held.readAllBytes()).decode() == token
        held.close()
        if mine:
            return n


def _publish(spark: SparkSession, root: str, name: str, write) -> tuple[int, str]:
    version = _claim(spark, root, name)
    path = f"{model_dir(root, name)}/v={version:04d}"
    write(path)
    fs, mark = _fs(spark, f"{path}/_PUBLISHED")
    fs.create(mark, False).close()
    return version, path


def save_versioned(spark: SparkSession, model, root: str, name: str) -> tuple[int, str]:
    """K5: save as the next version; returns (version, path)."""
    return _publish(spark, root, name, lambda path: model.write().save(path))


def save_table_versioned(spark: SparkSession, df: DataFrame, root: str, name: str) -> tuple[int, str]:
    """K5 for a model that is a table (a scaler's statistics): the next version."""
    return _publish(spark, root, name, lambda path: df.write.mode("errorifexists").parquet(path))


def keep_versions(spark: SparkSession, root: str, name: str, keep: int) -> list[int]:
    """Removes all published versions but the ``keep`` latest; returns the removed."""
    old = list_versions(spark, root, name)[:-keep] if keep > 0 else []
    for n in old:
        fs, path = _fs(spark, f"{model_dir(root, name)}/v={n:04d}")
        fs.delete(path, True)
    return old


def load_latest_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """K6 for such a table, or None."""
    versions = list_versions(spark, root, name)
    return spark.read.parquet(f"{model_dir(root, name)}/v={versions[-1]:04d}") if versions else None


def load_latest(spark: SparkSession, root: str, name: str, loader=PipelineModel):
    """K6: the latest saved version of ``name``, or None."""
    versions = list_versions(spark, root, name)
    if not versions:
        return None
    return loader.load(f"{model_dir(root, name)}/v={versions[-1]:04d}")


def control_record(params: dict, metrics: dict, exec_date: str, model_version: int | None,
                   train_date: str | None, is_train: bool, is_anomaly_exist: bool) -> dict:
    """K7 content: interpreter params and metrics, retrain and anomaly flags."""
    return {
        "interpreter_params": {str(k): str(v) for k, v in params.items()},
        "interpreter_metrics": {"exec_date": exec_date, **{k: float(v) for k, v in metrics.items()},
                                "interpreter_model_version": "" if model_version is None else str(model_version),
                                "interpreter_train_date": train_date or ""},
        "is_train_interpreter": bool(is_train),
        "is_anomaly_exist": bool(is_anomaly_exist),
    }


CONTROL_SCHEMA = ("interpreter_params map<string,string>, interpreter_metrics struct<exec_date:string, "
                  "f1_score_macro:double, accuracy:double, precision:double, recall:double, "
                  "interpreter_model_version:string, interpreter_train_date:string>, "
                  "is_train_interpreter boolean, is_anomaly_exist boolean")


def write_control_file(spark: SparkSession, record: dict, root: str, exec_date: str) -> str:
    """K7: one JSON document per execution date."""
    path = f"{root.rstrip('/')}/artifact/{exec_date}/control_file"
    df: DataFrame = spark.read.schema(CONTROL_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(record)]))
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_control_file(spark: SparkSession, root: str, exec_date: str) -> dict | None:
    path = f"{root.rstrip('/')}/artifact/{exec_date}/control_file"
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    row = spark.read.schema(CONTROL_SCHEMA).json(path).first()
    return row.asDict(recursive=True) if row else None
