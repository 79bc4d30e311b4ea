"""Column builders for the ingestion rules.

Spark 4 runs with ANSI casts: a plain ``cast`` raises on bad text, so every
text → typed conversion goes through the ``try_`` family and yields NULL,
which the nullability check (Q6) then counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRIMS = {"trim": F.trim, "ltrim": F.ltrim, "rtrim": F.rtrim}
_INTEGRAL = ("int", "bigint", "smallint", "tinyint")


def apply_trims(c: Column, methods) -> Column:
    """The listed trims, applied left to right."""
    for m in methods:
        c = _TRIMS[m](c)
    return c


def parse_temporal(c: Column, source_format: str, spark_type: str) -> Column:
    """Parse with the rule's own source format (NULL when it does not match)."""
    ts = F.try_to_timestamp(c, F.lit(source_format))
    return ts.cast("date") if spark_type == "date" else ts


def typed(c: Column, spark_type: str) -> Column:
    """P7 (+P14): text or number → declared type, NULL on failure.

    Integral targets go through a decimal so numeric text with a fraction
    (``"17850.0"``, ``"1.5"``) truncates like a float → int conversion.
    """
    if spark_type in _INTEGRAL:
        # one route for "23", "1.5" and "17850.0": a failed try_cast is costly
        # per row, so we do not try the integer cast first
        return c.try_cast("decimal(38,10)").try_cast(spark_type)
    if spark_type == "boolean":
        return F.lower(c).try_cast("boolean")
    return c.try_cast(spark_type)
