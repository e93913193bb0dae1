"""Column helpers shared by operators. All are built-in Spark expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: float64 machine epsilon, the floor for |y| in MAPE.
MAPE_EPS = 2.220446049250313e-16


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(c) -> Column:
    """NULL or NaN — both mean "missing" (pandas semantics)."""
    c = col_of(c)
    return c.isNull() | F.isnan(c)


def is_finite(c) -> Column:
    c = col_of(c)
    return (~missing(c)) & (c != F.lit(float("inf"))) & (c != F.lit(float("-inf")))


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (plain ``/`` raises under ANSI)."""
    return F.try_divide(col_of(a), col_of(b))


def iso_utc(c) -> Column:
    """Timestamp → ISO-8601 text in UTC with a ``Z`` suffix (text only on
    output; values stay ``TimestampType`` inside)."""
    return F.date_format(F.to_utc_timestamp(col_of(c), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def pct_diff(a, b) -> Column:
    """(a - b) / a * 100, and 0 when a = 0."""
    a, b = col_of(a), col_of(b)
    return F.when(a == 0, F.lit(0.0)).otherwise((a - b) / a * 100.0)
