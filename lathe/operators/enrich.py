"""Enrichment joins against a per-key lookup table.

The lookup is small by contract (one row per key), but its size is checked
before it is broadcast (``bounded_broadcast``); past the bound the join is a
shuffled one, re-planned by AQE at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathe.functions.columns import missing
from lathe.session import bounded_broadcast

MATCH = "_matched"


def dedup_lookup(lookup: DataFrame, key: str, order_by: list | None = None) -> DataFrame:
    """First row per key in a stated order (the serving path's "first match
    wins"). Without ``order_by`` the order is by every other column
    ascending — deterministic, so a recomputed task picks the same row (a
    distributed scan has no stable "file order"). ``row_number() <= 1`` is
    planned as a WindowGroupLimit, which also limits before the shuffle, so a
    hot key sends one row per task."""
    order = order_by or [F.col(c).asc_nulls_last() for c in lookup.columns if c != key] or [F.col(key)]
    w = Window.partitionBy(key).orderBy(*order)
    return lookup.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def enrich(df: DataFrame, lookup: DataFrame, key: str, on_missing: str = "keep", null_safe: bool = False,
           drop_key: bool = False, lookup_key: str | None = None, max_broadcast_rows: int = 1_000_000,
           flag: bool = False, allow_empty_lookup: bool = False) -> DataFrame:
    """Left-join ``lookup`` onto ``df`` on ``key``.

    * ``on_missing``: ``keep`` (NULL lookup columns), ``drop`` (inner) or
      ``reject`` — every row stays and carries ``_matched``, so the caller
      routes the unmatched ones to a dead letter; none is lost.
    * ``null_safe``: NULL keys match NULL keys (pandas merge behaviour).
    * Lookup columns win name clashes; duplicate lookup keys multiply rows
      (use ``dedup_lookup`` first for first-match-wins).
    * ``flag``: keep a boolean ``_matched`` column.
    * An empty lookup raises ``ValueError`` unless ``allow_empty_lookup``.
    """
    lk = lookup_key or key
    if key not in df.columns:
        raise ValueError(f"Join key '{key}' not found in data")
    if lk not in lookup.columns:
        raise ValueError(f"Join key '{lk}' not found in lookup")
    extra = [c for c in lookup.columns if c != lk]
    right = lookup.select(F.col(lk).alias("_lk"), *extra, F.lit(True).alias(MATCH))
    right = bounded_broadcast(right, max_broadcast_rows, min_rows=0 if allow_empty_lookup else 1)
    left = df.drop(*[c for c in extra if c in df.columns])
    cond = left[key].eqNullSafe(right["_lk"]) if null_safe else left[key] == right["_lk"]
    if on_missing not in ("keep", "drop", "reject"):
        raise ValueError(f"unknown on_missing '{on_missing}'")
    how = "inner" if on_missing == "drop" else "left"
    out = left.join(right, cond, how).drop("_lk")
    out = out.withColumn(MATCH, F.coalesce(F.col(MATCH), F.lit(False)))
    if drop_key:
        out = out.drop(key)
    return out if flag or on_missing == "reject" else out.drop(MATCH)


def unmatched(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None,
              max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows whose key is NULL, empty or absent from the lookup (anti join)."""
    lk = lookup_key or key
    keys = bounded_broadcast(lookup.select(F.col(lk).alias("_lk")).distinct(), max_broadcast_rows)
    return df.join(keys, df[key] == keys["_lk"], "left_anti")


def join_missing_count(before: DataFrame, after: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing values (NULL or NaN) added by a join: after − before, over
    the columns of ``cols`` (default: all). Both sides are projected to a
    per-row null count and summed in one aggregate over their union."""
    def nulls(df):
        cs = [c for c in (cols or df.columns) if c in df.columns]
        floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
        gone = lambda c: missing(c) if c in floats else F.col(c).isNull()
        return sum((F.when(gone(c), 1).otherwise(0) for c in cs), F.lit(0)).cast("long")

    both = before.select(nulls(before).alias("_nb"), F.lit(0).cast("long").alias("_na")).unionByName(
        after.select(F.lit(0).cast("long").alias("_nb"), nulls(after).alias("_na")))
    return both.agg(F.coalesce(F.sum("_nb"), F.lit(0)).alias("nulls_before"),
                    F.coalesce(F.sum("_na"), F.lit(0)).alias("nulls_after")).select(
        "nulls_before", "nulls_after", (F.col("nulls_after") - F.col("nulls_before")).alias("missing_added"))
