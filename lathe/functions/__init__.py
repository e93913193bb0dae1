from lathe.functions.columns import (  # noqa: F401
    MAPE_EPS,
    col_of,
    is_finite,
    iso_utc,
    missing,
    pct_diff,
    safe_div,
)
