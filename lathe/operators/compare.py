"""Comparison of two models' predictions and prediction-log analytics; all
single aggregates (partial + final), pairs by an id join — never by list
position."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import pct_diff


def pair_predictions(a: DataFrame, b: DataFrame, id_col: str, col_a: str, col_b: str) -> DataFrame:
    """Inner join on the sample id; pairs where either side failed (NULL)
    are dropped. Adds ``diff = a − b`` and ``pct`` (0 when a = 0)."""
    j = a.select(id_col, col_a).join(b.select(id_col, col_b), id_col, "inner")
    j = j.filter(F.col(col_a).isNotNull() & F.col(col_b).isNotNull())
    return j.select(id_col, F.col(col_a).alias("pred_a"), F.col(col_b).alias("pred_b"),
                    (F.col(col_a) - F.col(col_b)).alias("diff"), pct_diff(col_a, col_b).alias("pct"))


def diff_statistics(pairs: DataFrame, quantile_method: str = "exact") -> DataFrame:
    """Mean, median, max, min and sample std of |diff|, and mean, median, max
    of |pct|. Medians are exact via ``operators.quantiles`` (bucketed for
    high-cardinality columns, so no single task holds every distinct value);
    the rest is one aggregate."""
    from lathe.operators.quantiles import quantiles

    absd = pairs.select(F.abs("diff").alias("d"), F.abs("pct").alias("p"))
    med = quantiles(absd, ["d", "p"], [0.5], quantile_method)
    d, p = F.col("d"), F.col("p")
    return absd.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.avg(d).alias("mean_abs_diff"),
        F.lit(med["d"][0]).cast("double").alias("median_abs_diff"), F.max(d).alias("max_abs_diff"),
        F.min(d).alias("min_abs_diff"), F.stddev_samp(d).alias("std_abs_diff"), F.avg(p).alias("mean_abs_pct"),
        F.lit(med["p"][0]).cast("double").alias("median_abs_pct"), F.max(p).alias("max_abs_pct"))


# Agreement buckets (< 5 %, 5–15 %, ≥ 15 %) and assessment
# thresholds on the high-agreement share.
AGREEMENT_CUTS = (5.0, 15.0)
ASSESSMENT = [(0.8, "Excellent"), (0.6, "Good"), (0.4, "Fair")]


def agreement(pairs: DataFrame) -> DataFrame:
    p = F.abs("pct")
    lo, hi = AGREEMENT_CUTS
    c = pairs.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(p < lo, 1)).alias("high"),
                  F.count(F.when((p >= lo) & (p < hi), 1)).alias("medium"), F.count(F.when(p >= hi, 1)).alias("low"))
    share = F.try_divide(F.col("high").cast("double"), F.col("total"))
    assess = F.when(F.col("total") < 2, F.lit("Insufficient data"))
    for t, name in ASSESSMENT:
        assess = assess.when(share > t, F.lit(name))
    assess = assess.otherwise(F.lit("Poor"))
    pct = lambda c: F.try_divide(F.col(c) * 100.0, F.col("total"))
    return c.select("total", "high", "medium", "low", pct("high").alias("high_pct"), pct("medium").alias("medium_pct"),
                    pct("low").alias("low_pct"), assess.alias("assessment"))


def success_rates(df: DataFrame, endpoints: dict[str, str]) -> DataFrame:
    """Per endpoint (name → prediction column): total, successes, percent."""
    aggs = []
    for name, c in endpoints.items():
        aggs.append(F.struct(F.lit(name).alias("endpoint"), F.count(F.lit(1)).alias("total"),
                             F.count(F.col(c)).alias("ok")))
    return (df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
            .withColumn("success_pct", F.try_divide(F.col("ok") * 100.0, F.col("total"))))


def prediction_ranges(df: DataFrame, models: dict[str, str]) -> DataFrame:
    aggs = [F.struct(F.lit(name).alias("model"), F.min(c).alias("min_pred"), F.max(c).alias("max_pred"),
                     F.avg(c).alias("mean_pred")) for name, c in models.items()]
    return df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("s")).select("s.*")


def ab_summary(pairs: DataFrame, info: dict) -> DataFrame:
    """Both models side by side (type, version, feature count) with the pair
    count, mean absolute difference and high-agreement share."""
    s = pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg(F.abs("diff")).alias("mean_abs_diff"),
                  F.try_divide(F.count(F.when(F.abs("pct") < AGREEMENT_CUTS[0], 1)) * 100.0,
                               F.count(F.lit(1))).alias("high_agreement_pct"))
    return s.select(*[F.lit(v).alias(k) for k, v in info.items()], "n_pairs", "mean_abs_diff", "high_agreement_pct")


# ------------------------------------------------------------------ log analytics
def log_stats(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("total_predictions"))


def log_by_endpoint(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))


def recent(log: DataFrame, as_of, ts: str = "ts", window: str = "1 day") -> DataFrame:
    """Rows strictly newer than ``as_of − window``. ``as_of`` is a datetime
    or a one-row DataFrame (its value is read once and used as a literal, so
    the predicate reaches the Parquet scan and date partitions are pruned)."""
    if isinstance(as_of, DataFrame):
        as_of = as_of.first()[0]
    if isinstance(as_of, dt.datetime):
        as_of = F.lit(as_of).cast(log.schema[ts].dataType)
    return log.filter(F.col(ts) > as_of - F.expr(f"INTERVAL {window}"))


def prediction_summary(log: DataFrame, by: str = "endpoint") -> DataFrame:
    """Per endpoint: count, min, max, mean, exact median (grouped quantile),
    sample std of the prediction; mean and total time. Two scans of the log."""
    from lathe.operators.quantiles import grouped_quantiles

    p = F.col("predicted_price")
    stats = log.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.min(p).alias("min_price"), F.max(p).alias("max_price"),
        F.avg(p).alias("mean_price"), F.stddev_samp(p).alias("std_price"),
        F.avg("processing_time_ms").alias("mean_time_ms"), F.sum("processing_time_ms").alias("total_time_ms"))
    med = grouped_quantiles(log, [by], "predicted_price", [0.5], ["median_price"])
    med = med.withColumnRenamed(by, "_by")
    return stats.join(med, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
