"""Regression evaluation in one aggregate pass.

Every metric is derived from per-group sums (count, Σ|e|, Σe², Σ|y|,
Σ|e|/max(|y|,eps)) plus ``var_pop(y)`` — a numerically stable central moment,
so SST is never computed as Σy² − n·ȳ². Spark runs it as partial + final
aggregation: one row per group crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import MAPE_EPS, col_of, missing, safe_div

METRICS = ["mae", "mse", "rmse", "r2", "mape", "wmape"]


def _metric_sums(y: Column, yhat: Column) -> list[Column]:
    pair = ~missing(y) & ~missing(yhat)
    y, yhat = F.when(pair, y), F.when(pair, yhat)
    e = yhat - y
    return [
        F.count(F.when(pair, 1)).alias("n"),
        F.count(F.when(~pair, 1)).alias("n_missing"),
        F.sum(F.abs(e)).alias("_sae"),
        F.sum(e * e).alias("_sse"),
        F.sum(F.abs(y)).alias("_say"),
        F.sum(F.abs(e) / F.greatest(F.abs(y), F.lit(MAPE_EPS))).alias("_sape"),
        F.var_pop(y).alias("_vary"),
    ]


def _metric_finish(prefix: str = "") -> list[Column]:
    n = F.col("n")
    sse, sst = F.col("_sse"), F.col("_vary") * F.col("n")
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - safe_div(sse, sst)))
    return [
        safe_div(F.col("_sae"), n).alias(f"{prefix}mae"),
        safe_div(sse, n).alias(f"{prefix}mse"),
        F.sqrt(safe_div(sse, n)).alias(f"{prefix}rmse"),
        r2.alias(f"{prefix}r2"),
        (safe_div(F.col("_sape"), n) * 100.0).alias(f"{prefix}mape"),
        (safe_div(F.col("_sae"), F.col("_say")) * 100.0).alias(f"{prefix}wmape"),
    ]


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "prediction", by: list[str] | tuple = (),
                       report_missing: bool = False) -> DataFrame:
    """MAE, MSE, RMSE, R², MAPE (percent), WMAPE (percent), and ``n``, per
    group of ``by`` (one row when ``by`` is empty).

    Every figure, ``n`` included, is over the rows that have both a target and
    a prediction; ``report_missing`` adds ``n_missing``, the rows that lack
    either (NULL or NaN).

    R²: 1 − SSE/SST; when SST = 0, 1 if SSE = 0 else 0. MAPE floors |y| at
    float64 epsilon. WMAPE is NULL when Σ|y| = 0.
    """
    by = list(by)
    sums = df.groupBy(*by).agg(*_metric_sums(col_of(y).cast("double"), col_of(yhat).cast("double")))
    return sums.select(*by, "n", *(["n_missing"] if report_missing else []), *_metric_finish())


def overfitting(metrics: DataFrame, by: list[str] | tuple = (), split_col: str = "split",
                on_zero: str = "null") -> DataFrame:
    """Train-vs-test overfitting figures from per-split metric rows.

    ``metrics`` holds one row per (by…, split) with the ``METRICS`` columns.
    Ratios: mae, mape, wmape are test/train, r2 is train/test. With
    ``on_zero="null"`` a ratio is NULL unless its denominator is > 0 (the
    ratio is omitted); with ``on_zero="zero"`` it is 0 when the denominator
    is 0 (baseline variant, which also names the gaps ``*_diff``).
    """
    by = list(by)
    pick = []
    for m in METRICS:
        for s in ("train", "test"):
            pick.append(F.max(F.when(F.col(split_col) == s, F.col(m))).alias(f"{s}_{m}"))
    wide = metrics.groupBy(*by).agg(*pick)
    tr, te = (lambda m: F.col(f"train_{m}")), (lambda m: F.col(f"test_{m}"))

    def ratio(num, den):
        if on_zero == "zero":
            return F.when(den != 0, num / den).otherwise(F.lit(0.0))
        return F.when(den > 0, num / den)

    cols = [
        ratio(te("mae"), tr("mae")).alias("overfitting_ratio_mae"),
        ratio(tr("r2"), te("r2")).alias("overfitting_ratio_r2"),
        ratio(te("mape"), tr("mape")).alias("overfitting_ratio_mape"),
        ratio(te("wmape"), tr("wmape")).alias("overfitting_ratio_wmape"),
    ]
    if on_zero == "zero":
        cols += [
            (tr("r2") - te("r2")).alias("overfitting_r2_diff"),
            (te("mape") - tr("mape")).alias("overfitting_mape_diff"),
            (te("wmape") - tr("wmape")).alias("overfitting_wmape_diff"),
            (te("mae") - tr("mae")).alias("mae_gap"),
            (te("mape") - tr("mape")).alias("mape_gap"),
            (te("wmape") - tr("wmape")).alias("wmape_gap"),
        ]
    else:
        cols += [
            (tr("r2") - te("r2")).alias("r2_gap"),
            (tr("r2") - te("r2")).alias("overfitting_r2_diff"),
            (te("mae") - tr("mae")).alias("mae_gap"),
            (te("rmse") - tr("rmse")).alias("rmse_gap"),
            (te("mape") - tr("mape")).alias("mape_gap"),
            (te("wmape") - tr("wmape")).alias("wmape_gap"),
        ]
    return wide.select(*by, *[F.col(c) for c in wide.columns if c not in by], *cols)


# Performance tiers by test R² and overfitting tiers by the R²
# ratio, with their scores.
PERFORMANCE_TIERS = [(0.9, "Excellent"), (0.8, "Good"), (0.7, "Fair"), (0.5, "Poor")]
PERFORMANCE_LOWEST = "Very Poor"
OVERFITTING_TIERS = [(1.1, "Minimal"), (1.3, "Moderate"), (1.5, "High")]
OVERFITTING_HIGHEST = "Severe"
PERFORMANCE_SCORES = {"Excellent": 5.0, "Good": 4.0, "Fair": 3.0, "Poor": 2.0, "Very Poor": 1.0}
OVERFITTING_SCORES = {"Minimal": 4.0, "Moderate": 3.0, "High": 2.0, "Severe": 1.0}


def _score(label: Column, table: dict) -> Column:
    expr = None
    for k, v in table.items():
        expr = (F.when(label == k, F.lit(v)) if expr is None else expr.when(label == k, F.lit(v)))
    return expr.otherwise(F.lit(0.0))


def performance_summary(over: DataFrame) -> DataFrame:
    """Add tier labels and scores to an ``overfitting`` frame. A missing
    (NULL) R² ratio counts as 1.0, as in the reference; the NULL ratio stays
    visible beside it."""
    r2 = F.col("test_r2")
    perf = F.when(r2 >= PERFORMANCE_TIERS[0][0], F.lit(PERFORMANCE_TIERS[0][1]))
    for t, name in PERFORMANCE_TIERS[1:]:
        perf = perf.when(r2 >= t, F.lit(name))
    perf = perf.otherwise(F.lit(PERFORMANCE_LOWEST))
    ratio = F.coalesce(F.col("overfitting_ratio_r2"), F.lit(1.0))
    ovf = F.when(ratio <= OVERFITTING_TIERS[0][0], F.lit(OVERFITTING_TIERS[0][1]))
    for t, name in OVERFITTING_TIERS[1:]:
        ovf = ovf.when(ratio <= t, F.lit(name))
    ovf = ovf.otherwise(F.lit(OVERFITTING_HIGHEST))
    return (over.withColumn("performance_level", perf)
            .withColumn("overfitting_level", ovf)
            .withColumn("overfitting_ratio", ratio)
            .withColumn("performance_score", _score(F.col("performance_level"), PERFORMANCE_SCORES))
            .withColumn("overfitting_score", _score(F.col("overfitting_level"), OVERFITTING_SCORES)))


def cv_statistics(scores: DataFrame, by: list[str] | tuple = (), metric_col: str = "metric",
                  value_col: str = "score", fold_col: str = "fold") -> DataFrame:
    """Per metric: mean, population std, min, max and the fold scores in fold
    order. Metric names starting ``neg_`` (after a ``train_``/``test_``
    prefix) are renamed and sign-flipped."""
    by = list(by)
    name = F.col(metric_col)
    is_neg = name.rlike("^(train_|test_)?neg_")
    clean = scores.select(
        *by,
        F.regexp_replace(name, "neg_", "").alias(metric_col),
        F.col(fold_col),
        F.when(is_neg, -F.col(value_col)).otherwise(F.col(value_col)).alias(value_col),
    )
    return clean.groupBy(*by, metric_col).agg(
        F.avg(value_col).alias("mean"),
        F.stddev_pop(value_col).alias("std"),
        F.min(value_col).alias("min"),
        F.max(value_col).alias("max"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(fold_col), F.col(value_col)))),
                    lambda s: s[value_col]).alias("scores"),
    )


def format_metric(name: Column, value: Column) -> Column:
    """Display text chosen by metric name: money ``$1,234.50`` for
    mae/mse/rmse and money gaps, ``0.1234`` for r2, ratios and r2 gaps,
    ``12.34%`` for mape/wmape and their gaps."""
    base = F.regexp_replace(name, "^(train_|test_)", "")
    money = F.concat(F.lit("$"), F.format_number(value, 2))
    pct = F.concat(F.format_string("%.2f", value), F.lit("%"))
    dec = F.format_string("%.4f", value)
    return (F.when(base.isin("mae", "mse", "rmse"), money)
            .when(base == "r2", dec)
            .when(base.isin("mape", "wmape"), pct)
            .when(base.contains("ratio"), dec)
            .when(base.contains("gap") & base.isin("r2_gap", "overfitting_r2_diff"), dec)
            .when(base.contains("gap") & base.isin("mape_gap", "wmape_gap"), pct)
            .when(base.contains("gap"), money)
            .otherwise(dec))
