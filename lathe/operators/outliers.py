"""IQR outlier removal on the target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.quantiles import quantiles

# IQR multiplier presets.
IQR_PRESETS = {"iqr": 1.5, "iqr_strict": 1.0, "iqr_loose": 2.0}


def iqr_bounds(df: DataFrame, col: str, multiplier: float = 1.5, method: str = "exact") -> tuple[float, float]:
    """(Q1 − m·IQR, Q3 + m·IQR) with linearly interpolated quartiles."""
    q1, q3 = quantiles(df, [col], [0.25, 0.75], method)[col]
    if q1 is None:
        return None, None
    iqr = q3 - q1
    return q1 - multiplier * iqr, q3 + multiplier * iqr


def remove_outliers(df: DataFrame, col: str, multiplier: float = 1.5, method: str = "iqr",
                    fit_on: DataFrame | None = None, quantile_method: str = "exact") -> DataFrame:
    """Keep rows with ``lo <= col <= hi`` (inclusive); a NULL target drops.

    Bounds come from ``fit_on`` (default: ``df`` itself, as the reference
    does before splitting). An unknown ``method`` is a no-op. Fitting is one
    aggregate; the filter is a plain predicate on literals.
    """
    if method not in IQR_PRESETS and method != "iqr":
        return df
    lo, hi = iqr_bounds(fit_on if fit_on is not None else df, col, multiplier, quantile_method)
    if lo is None:
        return df.limit(0)
    return df.filter((F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi)))


def removed_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """initial, final, removed count and percent removed (of the initial)."""
    both = before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a")))
    return (both.agg(F.sum("_b").cast("long").alias("initial_count"), F.sum("_a").cast("long").alias("final_count"))
            .select(F.coalesce("initial_count", F.lit(0)).alias("initial_count"),
                    F.coalesce("final_count", F.lit(0)).alias("final_count"))
            .withColumn("removed_count", F.col("initial_count") - F.col("final_count"))
            .withColumn("removed_pct", F.try_divide(F.col("removed_count") * 100.0, F.col("initial_count"))))
