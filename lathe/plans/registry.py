from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame`` and its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 4, per_col: dict | None = None) -> DataFrame:
    """Round floating columns for the order-insensitive comparison with the
    oracle (float sums depend on summation order); ``+ 0.0`` folds −0.0."""
    per_col = per_col or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append((F.round(F.col(f"`{f.name}`"), per_col.get(f.name, digits)) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
