"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (Catalyst would inline
    a projected column into every use inside a lambda)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, _UPPER, _UPPER.lower())


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def row_key(*cols: Column | str) -> Column:
    """128 bits of the columns' values as hex text: rows with equal values
    have equal keys, nulls included."""
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *cols)), 16, "0") for seed in (0, 1)])


def neighbours(ids: DataFrame, key: str, carry: str | None = None) -> DataFrame:
    """``key, next_key, next_first`` (and ``prev_<carry>``) for the distinct
    values of ``key`` in ascending order (null first), the last followed by
    the first.

    The order is built from range partitions: ``lead``/``lag`` run inside each
    partition, and the one first and last row per partition (a table with a
    row per partition) bridge the borders, so no task holds the whole order.
    ``ids`` must hold each key once.
    """
    spark = ids.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = materialize(ids.repartitionByRange(n, F.col(key).asc_nulls_first())
                       .withColumn("_pid", F.spark_partition_id()), "order")
    got = [F.col(key), F.col(carry)] if carry else [F.col(key)]
    ends = part.groupBy("_pid").agg(
        F.min_by(F.struct(*got), F.struct(F.col(key).isNotNull(), key)).alias("_first"),
        F.max_by(F.struct(*got), F.struct(F.col(key).isNotNull(), key)).alias("_last"))
    # one row per range partition: bounded by spark.sql.shuffle.partitions
    ring = Window.partitionBy(F.lit(1)).orderBy("_pid")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "_pid",
        F.coalesce(F.lead("_first").over(ring), F.first("_first").over(whole)).alias("_after"),
        F.coalesce(F.lag("_last").over(ring), F.last("_last").over(whole)).alias("_before"))
    w = Window.partitionBy("_pid").orderBy(F.col(key).asc_nulls_first())
    here = F.struct(*got)
    out = part.withColumn("_lead", F.lead(here).over(w)).withColumn("_lag", F.lag(here).over(w))
    out = out.join(F.broadcast(ends), "_pid")
    nxt, prv = F.coalesce("_lead", "_after"), F.coalesce("_lag", "_before")
    cols = [F.col(key), nxt[key].alias("next_key"), prv[key].alias("prev_key")]
    if carry:
        cols.append(prv[carry].alias(f"prev_{carry}"))
    return out.select(*cols)


def ordinals(df: DataFrame, key: str, nulls_last: bool = True) -> DataFrame:
    """``_ordinal`` (from 0) of each row in ascending ``key`` order, from range
    partitions and one offset per partition; ``key`` must be unique."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(key).asc_nulls_last() if nulls_last else F.col(key).asc_nulls_first()
    part = materialize(df.repartitionByRange(n, order).withColumn("_pid", F.spark_partition_id()), "ordinals")
    before = Window.partitionBy(F.lit(1)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(  # a row per range partition
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_pid").orderBy(order)
    return (part.join(F.broadcast(starts), "_pid")
            .withColumn("_ordinal", F.col("_start") + F.row_number().over(within) - 1).drop("_pid", "_start"))


def rank_in(df: DataFrame, group: list[str], key: Column) -> DataFrame:
    """``_rank`` (from 1) of each row by the hex text ``key`` within ``group``,
    and ``_of``, the group's rows. Rows are ranked inside buckets of the key's
    first three digits, offset by the counts of the buckets before, so a
    group is never sorted by one task."""
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 3))
    cut = [*group, "_bucket"]
    counts = keyed.groupBy(*cut).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_bucket")  # at most 4096 buckets of a group
    starts = counts.select(*cut, (F.sum("_n").over(w) - F.col("_n")).alias("_start"),
                           F.sum("_n").over(Window.partitionBy(*group)).alias("_of"))
    within = Window.partitionBy(*cut).orderBy("_key")
    return (keyed.withColumn("_row", F.row_number().over(within)).join(starts, cut)
            .withColumn("_rank", F.col("_start") + F.col("_row")).drop("_key", "_bucket", "_row", "_start"))
