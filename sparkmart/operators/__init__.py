"""Analytics operators.  Each function takes and returns DataFrames (lazy)."""
