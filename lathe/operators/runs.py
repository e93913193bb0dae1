"""Run tracking as tables.

A sweep evaluates several model specs on one split. Every run's scored rows
are unioned and measured by **one** grouped metric aggregate; results are a
``runs`` table (one row per run) and a long ``run_values`` table
(``run_id, kind, key, value_num, value_str``) that is appended to storage
and pivoted to the wide, prefixed layout (``metrics.*``, ``tags.*``) on read.
A spec that fails, while it is planned or while it executes, is isolated: its
run is recorded as FAILED with the error text and the sweep goes on.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.operators.evaluate import METRICS, overfitting, regression_metrics
from lathe.session import materialize

RUN_METRICS = ([f"{s}_{m}" for s in ("train", "test") for m in METRICS]
               + ["overfitting_ratio_mae", "overfitting_ratio_r2", "overfitting_ratio_mape", "overfitting_ratio_wmape",
                  "r2_gap", "overfitting_r2_diff", "mae_gap", "rmse_gap", "mape_gap", "wmape_gap"])
RUNS_SCHEMA = "run_id string, experiment string, run_name string, model_type string, status string, " \
              "start_time timestamp_ntz, error string"
VALUES_SCHEMA = "run_id string, kind string, key string, value_num double, value_str string"


def sweep(spark: SparkSession, split_df: DataFrame, specs: list[dict], target: str, experiment: str,
          start: dt.datetime, params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Evaluate ``specs`` (each ``{"run_name", "model_type", "score": fn}``
    where ``fn(split_df) -> DataFrame[split, target, prediction]``) and return
    ``(runs, run_values)``."""
    runs, values, scored = [], [], []
    for i, spec in enumerate(specs):
        run_id = f"{experiment}-{i:03d}"
        t0 = time.time()
        try:
            # written inside the try: a run that fails while it executes is isolated too, and its time is real
            sc = materialize(spec["score"](split_df).select("split", target, "prediction"), "run")
            sc = sc.withColumn("run_id", F.lit(run_id))
            status, err = "FINISHED", None
            scored.append(sc)
        except Exception as e:  # noqa: BLE001 — failure isolation per run
            status, err = "FAILED", f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
        runs.append((run_id, experiment, spec["run_name"], spec["model_type"], status,
                     start + dt.timedelta(minutes=i), err))
        values.append((run_id, "tag", "model_type", None, spec["model_type"]))
        values.append((run_id, "tag", "mlflow.runName", None, spec["run_name"]))
        values.append((run_id, "metric", "training_time_s", time.time() - t0, None))
        for k, v in (params or {}).items():
            values.append((run_id, "param", k, None, str(v)))
    runs_df = spark.createDataFrame(runs, RUNS_SCHEMA)
    meta = spark.createDataFrame(values, VALUES_SCHEMA)
    if not scored:
        return runs_df, meta
    allsc = scored[0]
    for s in scored[1:]:
        allsc = allsc.unionByName(s)
    per_split = regression_metrics(allsc, target, "prediction", by=["run_id", "split"])
    over = overfitting(per_split, by=["run_id"])
    metric_rows = over.select("run_id", F.explode(F.array(*[
        F.struct(F.lit(m).alias("key"), F.col(m).cast("double").alias("value_num")) for m in RUN_METRICS])).alias("s"))
    metric_rows = metric_rows.select("run_id", F.lit("metric").alias("kind"), "s.key", "s.value_num",
                                     F.lit(None).cast("string").alias("value_str"))
    return runs_df, meta.unionByName(metric_rows)


def runs_wide(runs: DataFrame, values: DataFrame, metrics: list[str] = [*RUN_METRICS, "training_time_s"]) -> DataFrame:
    """One row per run: run columns, ``metrics.<name>`` and ``tags.<name>``
    columns (pivot with explicit values: no extra pass to discover them)."""
    m = (values.filter(F.col("kind") == "metric").groupBy("run_id").pivot("key", list(metrics))
         .agg(F.first("value_num")))
    m = m.select("run_id", *[F.col(k).alias(f"metrics.{k}") for k in metrics])
    tags = (values.filter(F.col("kind") == "tag").groupBy("run_id").pivot("key", ["model_type", "mlflow.runName"])
            .agg(F.first("value_str")))
    tags = tags.select("run_id", F.col("model_type").alias("tags.model_type"),
                       F.col("`mlflow.runName`").alias("tags.mlflow.runName"))
    return runs.join(m, "run_id", "left").join(tags, "run_id", "left")


def finished(wide: DataFrame) -> DataFrame:
    return wide.filter(F.col("status") == "FINISHED")


def ordered(wide: DataFrame, metric: str = "test_r2", ascending: bool = False) -> DataFrame:
    """Runs ordered by a metric (NULLs last), with the position made explicit."""
    from pyspark.sql import Window

    c = F.col(f"`metrics.{metric}`")
    order = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    # Run tables are small (one row per run): a global window is bounded here.
    return wide.withColumn("position", F.row_number().over(Window.orderBy(order, "start_time", "run_id")))


def best_run(wide: DataFrame, metric: str = "test_r2", higher_is_better: bool = True) -> DataFrame:
    """Best finished run by ``metric``; NULL/NaN values are skipped; ties go
    to the earliest start. Empty when no run has the metric."""
    col = f"metrics.{metric}"
    if col not in wide.columns:
        return wide.limit(0).select(F.lit(None).cast("string").alias("run_id"))
    c = F.col(f"`{col}`")
    ok = wide.filter(c.isNotNull() & ~F.isnan(c))
    if "status" in wide.columns:
        ok = finished(ok)
    order = c.desc() if higher_is_better else c.asc()
    return ok.orderBy(order, "start_time", "run_id").limit(1).select(
        "run_id", F.col("`tags.mlflow.runName`").alias("run_name"), c.alias("metric_value"), "start_time",
        F.col("`tags.model_type`").alias("model_type"))


def compare_runs(wide: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Selected columns that exist, ``metrics.``/``tags.`` prefixes removed."""
    metrics = metrics or ["test_r2", "test_mae", "test_rmse", "train_r2", "overfitting_ratio_r2"]
    cols = ["run_id", "tags.mlflow.runName", "tags.model_type", "start_time", "status"] + [f"metrics.{m}" for m in metrics]
    have = [c for c in cols if c in wide.columns]
    return wide.select(*[F.col(f"`{c}`").alias(c.replace("metrics.", "").replace("tags.", "")) for c in have])


# Declared expectations per model type (minimum test R²,
# maximum training seconds).
EXPECTATIONS = [("knn", 0.3, 60.0), ("xgboost", 0.6, 300.0), ("lightgbm", 0.6, 180.0)]


def expectation_gate(wide: DataFrame, expectations: DataFrame, check_time: bool = True) -> DataFrame:
    """Join runs with per-model-type expectations → pass/fail per check. A run
    without a recorded time fails the time check."""
    j = wide.join(expectations, F.col("`tags.model_type`") == expectations["model_type"], "inner")
    r2_ok = F.coalesce(F.col("`metrics.test_r2`") >= F.col("min_r2"), F.lit(False))
    out = j.select("run_id", expectations["model_type"], F.col("`metrics.test_r2`").alias("test_r2"), "min_r2",
                   r2_ok.alias("r2_ok"), "max_training_time",
                   F.col("`metrics.training_time_s`").alias("training_time_s") if "metrics.training_time_s" in wide.columns
                   else F.lit(None).cast("double").alias("training_time_s"))
    t_ok = F.coalesce(F.col("training_time_s") <= F.col("max_training_time"), F.lit(False))
    return out.withColumn("time_ok", t_ok).withColumn("passed", F.col("r2_ok") & (F.col("time_ok") | F.lit(not check_time)))


def append_runs(runs: DataFrame, values: DataFrame, root: str) -> None:
    """Add runs to the store (Parquet, partitioned by experiment and run).

    Written with dynamic partition overwrite: re-running the same job (after
    a failure) replaces those runs' partitions instead of duplicating them.
    """
    (runs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("experiment", "run_id").parquet(f"{root}/runs"))
    (values.join(runs.select("run_id", "experiment"), "run_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("experiment", "run_id").parquet(f"{root}/run_values"))
