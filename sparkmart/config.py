"""Declarative per-table ingestion configuration and its validation (Q1-Q5).

A config is a JSON object::

    {"dataset": {"source": "bronze", "target": "silver"},      # optional
     "table_name": "...",
     "columns": [{"target_column", "source_column", "column_type", "nullable",
                  "transformation_rules": [{"trim": [...]},
                                           {"format_datetime": {"source_format", "target_format"}},
                                           {"round": n}]}],
     "new_columns": [...same shape...],                         # optional
     "primary_key": [...], "partition_column": [...]}
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from dataclasses import dataclass, field

# Config type names and the Spark types they declare.
# ("float" is widened from the published decimal(10,0) so fractions survive.)
TYPE_NAMES = {
    "str": "string",
    "int": "int",
    "long": "bigint",
    "float": "decimal(18,4)",
    "double": "double",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}
_DECIMAL = re.compile(r"^decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)$")
TRIM_METHODS = ("trim", "ltrim", "rtrim")
WRITE_MODES = ("overwrite", "append")
READ_FORMATS = ("csv", "json", "txt", "text", "parquet")
WRITE_FORMATS = ("parquet", "delta", "json", "csv", "orc")


class ConfigError(ValueError):
    pass


def spark_type(type_name: str) -> str:
    t = type_name.strip().lower()
    if t in TYPE_NAMES:
        return TYPE_NAMES[t]
    if _DECIMAL.match(t):
        return t
    raise ConfigError(f"unknown column_type {type_name!r}")


@dataclass(frozen=True)
class ColumnSpec:
    target: str
    source: str
    type_name: str
    nullable: bool
    rules: tuple = ()

    @property
    def spark_type(self) -> str:
        return spark_type(self.type_name)

    @property
    def is_temporal(self) -> bool:
        return self.spark_type in ("date", "timestamp")


@dataclass(frozen=True)
class TableConfig:
    table_name: str
    columns: tuple[ColumnSpec, ...]
    new_columns: tuple[ColumnSpec, ...] = ()
    primary_key: tuple[str, ...] = ()
    partition_column: tuple[str, ...] = ()
    source_dataset: str = ""
    target_dataset: str = ""
    extra: dict = field(default_factory=dict)

    @property
    def all_columns(self) -> tuple[ColumnSpec, ...]:
        return self.columns + self.new_columns

    @property
    def source_columns(self) -> list[str]:
        seen: list[str] = []
        for c in self.all_columns:
            if c.source not in seen:
                seen.append(c.source)
        return seen

    @property
    def date_partition_column(self) -> str | None:
        """The partition column that carries the business date (declared type date/timestamp)."""
        by_name = {c.target: c for c in self.all_columns}
        dated = [p for p in self.partition_column if p in by_name and by_name[p].is_temporal]
        return dated[0] if dated else None

    @property
    def extra_partition_columns(self) -> list[str]:
        """K2: configured partition columns other than the date one."""
        d = self.date_partition_column
        return [p for p in self.partition_column if p != d]


def _column(obj: dict, where: str) -> ColumnSpec:
    if not isinstance(obj, dict):
        raise ConfigError(f"{where}: expected an object")
    for k in ("target_column", "source_column", "column_type", "nullable"):
        if k not in obj:
            raise ConfigError(f"{where}: missing {k!r}")
    t = spark_type(obj["column_type"])
    rules = obj.get("transformation_rules") or []
    if not isinstance(rules, list):
        raise ConfigError(f"{where}.transformation_rules: expected a list")
    for i, r in enumerate(rules):
        w = f"{where}.transformation_rules[{i}]"
        if not isinstance(r, dict) or not r:
            raise ConfigError(f"{w}: expected a non-empty object")
        for name, arg in r.items():
            if name == "trim":
                if not isinstance(arg, list) or any(m not in TRIM_METHODS for m in arg):
                    raise ConfigError(f"{w}: trim takes a list of {TRIM_METHODS}")
            elif name == "format_datetime":
                if not isinstance(arg, dict) or "source_format" not in arg:
                    raise ConfigError(f"{w}: format_datetime needs source_format")
                if t not in ("date", "timestamp", "string"):
                    raise ConfigError(f"{w}: format_datetime on a {t} column")
            elif name == "round":
                if t in ("string", "boolean", "date", "timestamp"):
                    raise ConfigError(f"{w}: round is not allowed on a {obj['column_type']} column")
                if not isinstance(arg, int) or isinstance(arg, bool):
                    raise ConfigError(f"{w}: round takes an integer")
            else:
                raise ConfigError(f"{w}: unknown rule {name!r}")
    return ColumnSpec(obj["target_column"], obj["source_column"], obj["column_type"],
                      bool(obj["nullable"]), tuple(rules))


def parse_config(obj) -> TableConfig:
    """Q1-Q3: structural validation; raises ConfigError naming the path."""
    if isinstance(obj, str):
        obj = json.loads(obj)
    if isinstance(obj, list):
        if len(obj) != 1:
            raise ConfigError("expected exactly one table config")
        obj = obj[0]
    if not isinstance(obj, dict):
        raise ConfigError("config must be an object")
    for k in ("table_name", "columns", "primary_key", "partition_column"):
        if k not in obj:
            raise ConfigError(f"missing required key {k!r}")
    if not obj["columns"]:
        raise ConfigError("columns must not be empty")
    cols = tuple(_column(c, f"columns[{i}]") for i, c in enumerate(obj["columns"]))
    new = tuple(_column(c, f"new_columns[{i}]") for i, c in enumerate(obj.get("new_columns") or []))
    targets = [c.target for c in cols + new]
    if len(set(targets)) != len(targets):
        raise ConfigError("duplicate target_column")
    for k in ("primary_key", "partition_column"):
        if not isinstance(obj[k], list):
            raise ConfigError(f"{k} must be a list")
        missing = [c for c in obj[k] if c not in targets]
        if missing:
            raise ConfigError(f"{k}: unknown columns {missing}")
    by_name = {c.target: c for c in cols + new}
    dated = [p for p in obj["partition_column"] if by_name[p].is_temporal]
    if len(dated) > 1:
        raise ConfigError(f"partition_column: at most one date column, got {dated}")
    ds = obj.get("dataset") or {}
    if not isinstance(ds, dict):
        raise ConfigError("dataset must be an object")
    return TableConfig(obj["table_name"], cols, new, tuple(obj["primary_key"]),
                       tuple(obj["partition_column"]), ds.get("source", "") or "",
                       ds.get("target", "") or "")


def validate_args(dt: str | None, mode: str = "overwrite", read_format: str = "csv",
                  write_format: str = "parquet") -> str:
    """Q4: execution date (ISO ``yyyy-mm-dd``; today when omitted) and modes."""
    if dt is None:
        dt = _dt.date.today().isoformat()
    try:
        _dt.date.fromisoformat(dt)
    except ValueError as e:
        raise ConfigError(f"dt must be yyyy-mm-dd, got {dt!r}") from e
    if mode not in WRITE_MODES:
        raise ConfigError(f"mode must be one of {WRITE_MODES}")
    if read_format not in READ_FORMATS:
        raise ConfigError(f"read format must be one of {READ_FORMATS}")
    if write_format not in WRITE_FORMATS:
        raise ConfigError(f"write format must be one of {WRITE_FORMATS}")
    return dt


_URI = re.compile(r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/]+)(/.*)?$")


def validate_uri(uri: str) -> str:
    """Q5: a Hadoop-style URI (any scheme) or an absolute local path."""
    if uri.startswith("/"):
        return uri
    if not _URI.match(uri):
        raise ConfigError(f"not a valid URI: {uri!r}")
    return uri
