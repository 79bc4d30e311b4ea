"""Column names for an operator's own use beside a caller's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it differ from all of
    ``df``'s columns (Spark ignores case)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        out.append(name)
    return out
