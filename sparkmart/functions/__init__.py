"""Column-expression builders shared by the operators (all JVM-side built-ins)."""

from sparkmart.functions.columns import (  # noqa: F401
    binarize, days_between, money, round_half_up, ratio_half_up, safe_long_id,
)
