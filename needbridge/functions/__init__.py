"""Column expressions shared by the operators (all built-in, JVM-side)."""

from needbridge.functions.exprs import (  # noqa: F401
    age_years,
    allow_list,
    allow_list_violation,
    as_col,
    false_if_null,
    flag,
    padded_id,
    pct,
    round_half_even,
    row_sum_flags,
    safe_date,
    tier,
    trim_spaces,
)
