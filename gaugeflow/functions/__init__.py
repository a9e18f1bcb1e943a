"""Column expressions."""

from gaugeflow.functions.expr import (  # noqa: F401
    clean_dam_name,
    month_key,
    normalize_header,
    null_tokens,
    pct_of,
    rel_diff_pct,
    right,
    round_half_away,
    safe_label,
    strip_ws,
    try_double,
    try_int,
)
