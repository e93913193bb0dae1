"""Exact, reproducible train/test and k-fold splits.

A seeded permutation is a sort by ``md5(seed | id)``. A row's label needs
only the keys at the label borders, never its own rank:

1. count rows per bucket, the first ``digits`` hex chars of the key
   (16**digits buckets, filled evenly because md5 is uniform): one small row
   per bucket, a proven bound, read by the driver;
2. the border positions (the test size, or the fold sizes summed up) fall
   into at most k - 1 buckets; only these are ranked;
3. every row is labelled by comparing its key with the border keys: a narrow
   expression, so no data row is shuffled.

Rows whose id repeats share a key. Only where a border falls between such
rows are they (and no others) ranked, by a hash of the whole row.
``exact_rank`` gives the full ranking where ranks themselves are wanted.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"
HKEY = "_hkey"


def hash_key(id_cols: list[str], seed: int) -> Column:
    """md5 of ``seed|id1|id2...`` as hex text — identical in DuckDB."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols]))


def exact_rank(df: DataFrame, id_cols: list[str], seed: int = 42, digits: int = 4,
               rank_col: str = RANK) -> tuple[DataFrame, DataFrame]:
    """Add ``rank_col`` = 1..n in seeded-permutation order.

    Returns ``(ranked, bucket_counts)``; ``ranked`` also carries ``_total``
    (n); ``bucket_counts`` (``_bucket, _n, _offset, _total``) is the small
    broadcast table.
    """
    nbuckets = 16 ** digits
    keyed = df.withColumn(HKEY, hash_key(id_cols, seed)).withColumn(
        "_bucket", F.conv(F.substring(HKEY, 1, digits), 16, 10).cast("int"))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # Prefix sum over the bucket table: bounded by 16**digits rows.
    prefix = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_offset", F.coalesce(F.sum("_n").over(prefix), F.lit(0)))
               .withColumn("_total", F.sum("_n").over(Window.partitionBy())))
    if nbuckets > 1_048_576:
        raise ValueError("digits too large: bucket table must stay broadcastable")
    # ties (repeated ids) are broken by a hash of the whole row, so a
    # recomputed task assigns the same ranks
    within = Window.partitionBy("_bucket").orderBy(HKEY, *id_cols, F.xxhash64(*[F.col(c) for c in df.columns]))
    ranked = (keyed.join(F.broadcast(offsets.select("_bucket", "_offset", "_total")), "_bucket")
              .withColumn(rank_col, F.col("_offset") + F.row_number().over(within))
              .drop("_bucket", "_offset", HKEY))
    return ranked, offsets


def n_test_rows(n: int, test_size: float) -> int:
    """scikit-learn rule: n_test = ceil(test_size * n)."""
    return int(math.ceil(test_size * n))


def _borders(df: DataFrame, id_cols: list[str], seed: int, positions, digits: int) -> list[tuple[str, int, int]]:
    """For each position p of ``positions(n)`` (rows before the border) the
    border key, how many of its rows lie before the border, and how many rows
    have it."""
    if 16 ** digits > 1_048_576:
        raise ValueError("digits too large: the bucket counts are read by the driver")
    keys = df.select(hash_key(id_cols, seed).alias(HKEY))
    counts = keys.groupBy(F.substring(HKEY, 1, digits).alias("b")).count().toPandas().sort_values("b")
    n, before = int(counts["count"].sum()), counts["count"].cumsum() - counts["count"]
    wanted: dict[str, list[int]] = {}
    spots = []
    for p in positions(n):
        if not 0 < p < n:
            spots.append(("" if p <= 0 else "g", None))  # below and above every hex key
            continue
        row = int((before < p).sum()) - 1
        bucket, at = counts["b"].iloc[row], p - int(before.iloc[row])
        wanted.setdefault(bucket, []).append(at)
        spots.append((bucket, at))
    found = {}
    if wanted:
        w = Window.partitionBy("_b").orderBy(HKEY)
        ranked = keys.withColumn("_b", F.substring(HKEY, 1, digits)).where(F.col("_b").isin(list(wanted)))
        ranked = ranked.groupBy("_b", HKEY).agg(F.count(F.lit(1)).alias("_same")).withColumn(
            "_end", F.sum("_same").over(w))
        hit = [(F.col("_b") == b) & (F.col("_end") >= at) & (F.col("_end") - F.col("_same") < at)
               for b, ats in wanted.items() for at in ats]
        for r in ranked.where(functools.reduce(lambda x, y: x | y, hit)).collect():  # at most a row per border
            for at in wanted[r["_b"]]:
                if r["_end"] - r["_same"] < at <= r["_end"]:
                    found[r["_b"], at] = (r[HKEY], at - (r["_end"] - r["_same"]), r["_same"])
    return [found[s] if s in found else (s[0], 0, 0) for s in spots]


def _label(df: DataFrame, id_cols: list[str], seed: int, borders: list[tuple[str, int, int]], out: str) -> DataFrame:
    """``out`` = number of borders a row lies at or beyond."""
    key = hash_key(id_cols, seed)
    beyond = lambda k: sum((F.when(k > h, 1).otherwise(0) for h, _, _ in borders), F.lit(0))
    cut = sorted({h for h, inside, same in borders if 0 < inside < same})  # a border among equal keys
    if not cut:
        return df.withColumn(out, beyond(key).cast("int"))
    w = Window.partitionBy(HKEY).orderBy(F.xxhash64(*[F.col(c) for c in df.columns]))
    keyed = df.withColumn(HKEY, key)
    tied = keyed.where(F.col(HKEY).isin(cut)).withColumn(RANK, F.row_number().over(w))
    over = sum((F.when((F.col(HKEY) == h) & (F.col(RANK) > inside), 1).otherwise(0)
                for h, inside, same in borders if 0 < inside < same), beyond(F.col(HKEY)))
    return (keyed.where(~F.col(HKEY).isin(cut)).withColumn(out, beyond(F.col(HKEY)).cast("int")).drop(HKEY)
            .unionByName(tied.withColumn(out, over.cast("int")).drop(HKEY, RANK)))


def split(df: DataFrame, id_cols: list[str], test_size: float = 0.2, seed: int = 42,
          split_col: str = "split", digits: int = 4) -> DataFrame:
    """Label each row ``train`` or ``test``: exactly ceil(n·test_size) test
    rows, disjoint, deterministic per seed, independent of partitioning."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be in (0, 1)")
    borders = _borders(df, id_cols, seed, lambda n: [n_test_rows(n, test_size)], digits)
    return _label(df, id_cols, seed, borders, split_col).withColumn(
        split_col, F.when(F.col(split_col) == 0, F.lit("test")).otherwise(F.lit("train")))


def fold_of(rank0: Column, n: Column, k: int) -> Column:
    """Fold of the 0-based position ``rank0`` for n rows in k folds: the first
    n mod k folds hold one extra row (scikit-learn KFold)."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(rank0 < big, F.floor(rank0 / (q + 1))).otherwise(r + F.floor((rank0 - big) / q)).cast("int")


def kfold(df: DataFrame, id_cols: list[str], k: int = 5, seed: int = 42, fold_col: str = "fold",
          digits: int = 4) -> DataFrame:
    """Assign each row a fold 0..k-1 with sizes differing by at most one."""
    if k < 2:
        raise ValueError("k must be at least 2")
    def ends(n: int) -> list[int]:  # the first n mod k folds hold one row more
        return [f * (n // k) + min(f, n % k) for f in range(1, k)]

    return _label(df, id_cols, seed, _borders(df, id_cols, seed, ends, digits), fold_col)
