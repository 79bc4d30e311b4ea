"""SQL text helpers for the oracle queries (plain ANSI-ish SQL, DuckDB dialect).

The oracles are written independently of the Spark plans (windows and SQL
aggregates instead of the distributed index), so agreement is evidence.
Money is rounded with exact integer arithmetic because DuckDB divides
decimals in double precision.
"""

from sparkmart.sources.tables import FACT_SQL


def hu(num: str, den: str) -> str:
    """Integer ``num / den`` rounded half away from zero, exactly."""
    return (f"(CASE WHEN ({num}) >= 0 THEN (2*({num}) + ({den})) // (2*({den})) "
            f"ELSE -((2*(-({num})) + ({den})) // (2*({den}))) END)")


def hu2(num_cents: str, den: str) -> str:
    """``num_cents / den`` in currency units, rounded half up to 2 places, DOUBLE."""
    return f"CAST({hu(num_cents, den)} AS DOUBLE) / 100.0"


def cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch({later}) - epoch({earlier})) / 86400) AS INTEGER)"


def with_fact(body: str, extra_ctes: str = "") -> str:
    ctes = f"fact AS ({FACT_SQL})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"
