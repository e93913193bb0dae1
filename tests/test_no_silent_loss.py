"""Rows are kept or reported, never dropped silently."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lathe.operators import runs as R
from lathe.operators.crossval import cv_group_mean
from lathe.operators.enrich import enrich, join_missing_count
from lathe.operators.evaluate import regression_metrics
from lathe.operators.features import fit_scaler
from lathe.operators.knn import knn_join
from lathe.operators.validate import check_dataset
from lathe.sources.sinks import fingerprint, log_predictions, read_log
from lathe.streaming.pipeline import run_to_completion

NAN = float("nan")


def test_metrics_count_pairs_and_report_the_rest(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (None, 3.0), (4.0, NAN)], "y double, prediction double")
    r = regression_metrics(df, "y", "prediction", report_missing=True).first()
    assert (r["n"], r["n_missing"], r["mae"]) == (1, 3, 1.0)


def test_cross_validation_keeps_rows_with_a_null_key(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"k{i % 3}", float(i % 7)) for i in range(100)],
                               "id int, k string, y double")
    filled = df.withColumn("k", F.coalesce("k", F.lit("null")))
    key = lambda d: sorted((r["fold"], r["metric"], round(r["score"], 9)) for r in cv_group_mean(d, ["id"], "k", "y").collect())
    assert key(df) == key(filled)


def test_knn_raises_on_missing_features(spark):
    pts = spark.createDataFrame([(i, float(i)) for i in range(9)], "pid int, x double")
    for gap in (None, NAN):
        q = spark.createDataFrame([(1, 2.0), (2, gap)], "qid int, x double")
        with pytest.raises(ValueError, match="missing"):
            knn_join(q, pts, ["x"], 2)


def test_reject_keeps_unmatched_rows_flagged(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    lk = spark.createDataFrame([("a", 1.0)], "k string, v double")
    got = {r["id"]: r["_matched"] for r in enrich(df, lk, "k", on_missing="reject").collect()}
    assert got == {1: True, 2: False, 3: False}
    with pytest.raises(ValueError):
        enrich(df, lk, "k", on_missing="other")


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(NAN, 1.0, NAN), (NAN, 3.0, NAN), (NAN, NAN, NAN)], "a double, b double, y double")
    checks = {r["check"]: r["passed"] for r in check_dataset(df, ["a", "b"], "y").collect()}
    assert not checks["no_all_null_columns"] and not checks["target_not_all_null"]
    assert fit_scaler(df, ["b"], "standard")["center"]["b"] == 2.0
    assert fit_scaler(df, ["b"], "minmax")["scale"]["b"] == 2.0
    r = join_missing_count(df.select("b"), df.select("b", "a")).first()
    assert (r["nulls_before"], r["nulls_after"]) == (1, 4)


def test_unfinished_stream_raises(spark, tmp_path):
    spark.range(40).repartition(40).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    writer = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "chk"))
    with pytest.raises(TimeoutError):
        run_to_completion(writer, timeout_s=0.2)
    assert not spark.streams.active


def test_failing_execution_is_isolated_and_gate_uses_recorded_time(spark):
    s = spark.createDataFrame([(i, "test" if i % 4 == 0 else "train", float(i)) for i in range(40)], "id int, split string, y double")
    ok = lambda d: d.withColumn("prediction", F.col("y") + 1)
    bad = lambda d: d.withColumn("prediction", F.raise_error(F.lit("boom")).cast("double"))
    runs, vals = R.sweep(spark, s, [{"run_name": n, "model_type": "knn", "score": f} for n, f in (("a", ok), ("b", bad))],
                         "y", "e", dt.datetime(2024, 1, 1))
    w = R.runs_wide(runs, vals)
    got = {r["run_name"]: r for r in w.collect()}
    assert got["a"]["status"] == "FINISHED" and got["b"]["status"] == "FAILED" and got["a"]["metrics.training_time_s"] > 0
    better = w.withColumn("status", F.lit("FAILED")).withColumn("metrics.test_r2", F.lit(9.0)).withColumn("run_id", F.lit("x"))
    assert R.best_run(w.unionByName(better)).first()["run_id"] == "e-000"
    exp = spark.createDataFrame([("knn", 0.1, 60.0)], "model_type string, min_r2 double, max_training_time double")
    slow = w.withColumn("metrics.training_time_s", F.lit(1e9))
    gate = lambda d: {r["run_id"]: (r["time_ok"], r["passed"]) for r in R.expectation_gate(d, exp).collect()}
    assert gate(w)["e-000"] == (True, True) and gate(slow)["e-000"] == (False, False)
    assert gate(w.drop("metrics.training_time_s"))["e-000"] == (False, False)


def test_busy_log_partition_is_split_and_fingerprint_sees_nulls(spark, tmp_path):
    df = spark.range(400_000).select(F.col("id").cast("string"), F.lit("/v1").alias("endpoint"), F.timestamp_seconds(
        F.lit(1_700_000_000)).alias("ts"), F.md5(F.col("id").cast("string")).alias("zipcode"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        log_predictions(df.repartition(8), str(tmp_path / "log"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = read_log(spark, str(tmp_path / "log"))
    assert back.count() == 400_000 and len(back.inputFiles()) > 1
    one = spark.createDataFrame([(1, None), (2, "")], "a int, b string")
    two = spark.createDataFrame([(1, ""), (2, None)], "a int, b string")
    assert fingerprint(one).first()["digest"] != fingerprint(two).first()["digest"]
