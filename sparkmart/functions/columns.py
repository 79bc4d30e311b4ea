"""Small Column builders.  Every one is a composition of built-in functions,
so it stays inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Currency amount as an exact decimal, so sums do not depend on order."""
    return _c(c).cast(MONEY)


def round_half_up(c, digits: int = 2, as_double: bool = True) -> Column:
    """Round half away from zero on the exact decimal value.

    Rounding a double directly is at the mercy of its binary representation
    (2.675 is stored as 2.67499...), so callers pass decimals; the result is
    cast to double for reporting.
    """
    r = F.round(_c(c), digits)
    return r.cast("double") if as_double else r


def ratio_half_up(num, den, digits: int = 2) -> Column:
    """``num / den`` with exact decimal division, rounded half up, as double.

    ``num`` is an integral or scale-≤2 decimal column, ``den`` a count.  The
    operand widths keep 14 fractional digits in Spark's decimal division, so
    the half-up step sees the exact quotient for any count below 10**12.
    """
    return F.round(exact_div(num, den), digits).cast("double")


def exact_div(num, den) -> Column:
    """Decimal quotient with 14 fractional digits (exact for rounding purposes)."""
    return _c(num).cast("decimal(26,2)") / _c(den).cast("decimal(12,0)")


def days_between(later, earlier) -> Column:
    """Whole days between two timestamps, floored (a timedelta's ``.days``)."""
    secs = epoch_seconds(later) - epoch_seconds(earlier)
    return F.floor(secs / F.lit(86400)).cast("int")


def epoch_seconds(c) -> Column:
    """Seconds since the epoch for TIMESTAMP and TIMESTAMP_NTZ alike (NTZ is
    read in the session zone, which we pin to UTC)."""
    return F.unix_seconds(_c(c).cast("timestamp"))


def safe_long_id(c) -> Column:
    """Id text such as ``"17850.0"`` → 17850: a float parse then an integral cast.

    A direct ``try_cast('17850.0' as bigint)`` is NULL, hence the two steps.
    """
    return _c(c).try_cast("double").try_cast("bigint")


def binarize(c) -> Column:
    """≤0 → 0, ≥1 → 1, anything strictly between (and NULL) → NULL."""
    x = _c(c)
    return F.when(x <= 0, F.lit(0)).when(x >= 1, F.lit(1))
