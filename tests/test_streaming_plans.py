import datetime as dt
import os

from pyspark.sql import functions as F

from lathe.session import new_path
from lathe.sources.sinks import log_predictions, read_log
from lathe.streaming.pipeline import log_batch_writer, rolling_counts, run_to_completion

SF = "/root/testdata/sf0.01"


def test_replayed_batch_adds_no_rows(spark):
    path = new_path(spark, "log-test")
    batch = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5), "a", 1.0), (2, dt.datetime(2024, 1, 2, 5), "b", 2.0)],
                                  "id long, ts timestamp, endpoint string, predicted_price double")
    w = log_batch_writer(path)
    w(batch, 0)
    w(batch, 0)  # replay after a failure
    w(batch.limit(1), 1)
    back = spark.read.option("basePath", path).parquet(path)
    assert back.count() == 3


def test_late_rows_behind_watermark_are_dropped(spark):
    src = new_path(spark, "late-src")
    os.makedirs(src, exist_ok=True)
    schema = "ts timestamp, endpoint string"
    rows1 = [(dt.datetime(2024, 1, 3, 12), "a"), (dt.datetime(2024, 1, 5, 12), "a")]
    spark.createDataFrame(rows1, schema).coalesce(1).write.mode("append").parquet(src)  # one file: read in one batch
    out, chk = new_path(spark, "late-out"), new_path(spark, "late-chk")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = rolling_counts(stream, window="1 hour", slide="1 hour", watermark="1 hour")
    run_to_completion(q.writeStream.format("parquet").option("path", out).option("checkpointLocation", chk))
    # second file: one row far behind the watermark, one new row
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 30), "a"), (dt.datetime(2024, 1, 9, 0), "a")], schema).coalesce(1) \
        .write.mode("append").parquet(src)
    run_to_completion(q.writeStream.format("parquet").option("path", out).option("checkpointLocation", chk))
    starts = {r["window_start"] for r in spark.read.parquet(out).collect()}
    assert dt.datetime(2024, 1, 1, 0) not in starts  # late row dropped
    assert dt.datetime(2024, 1, 3, 12) in starts and dt.datetime(2024, 1, 5, 12) in starts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrich_is_broadcast_and_pushdown(spark):
    import __spark_entry__ as E

    p = _plan(E.queries()["enrich_left"](spark, SF))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    p = _plan(E.queries()["scan_select"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in p \
        or "l_tax" not in p  # pruned to the four requested columns


def test_no_python_in_non_knn_plans(spark):
    import __spark_entry__ as E

    for name in ["regression_metrics", "score_batch", "validate_rules", "iqr_filter", "cv_statistics", "kfold_assign"]:
        p = _plan(E.queries()[name](spark, SF))
        assert "Python" not in p and "ArrowEval" not in p, name


def test_log_partitions_pruned(spark):
    path = new_path(spark, "log-prune")
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 3, 1), "e" if i % 2 else "f", float(i))
                                for i in range(30)], "id long, ts timestamp, endpoint string, predicted_price double")
    log_predictions(df, path)
    back = read_log(spark, path).filter((F.col("log_date") == dt.date(2024, 1, 2)) & (F.col("endpoint") == "e"))
    plan = _plan(back)
    assert "PartitionFilters" in plan and "log_date" in plan
    assert back.count() == 5


def test_split_plan_has_no_single_partition_window_on_data(spark):
    import __spark_entry__ as E

    p = _plan(E.queries()["train_test_split"](spark, SF))
    # the only unpartitioned window is over the bounded bucket-count table
    assert p.count("SinglePartition") <= 2


def test_stream_scoring_writes_log_and_dead_letter(spark):
    from lathe.plans.q_stream import _scored_stream
    from lathe.streaming.pipeline import scoring_batch_writer

    sf = "/root/testdata/sf0.001"
    scored, dead, log = new_path(spark, "s-ok"), new_path(spark, "s-dead"), new_path(spark, "s-log")
    chk = new_path(spark, "s-chk")
    run_to_completion(_scored_stream(spark, sf).writeStream.foreachBatch(scoring_batch_writer(scored, dead, log))
                      .option("checkpointLocation", chk))
    n_ok = spark.read.parquet(scored).count()
    n_dead = spark.read.parquet(dead).count()
    assert n_ok + n_dead == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    back = read_log(spark, log)
    assert back.count() == n_ok and "predicted_price" in back.columns and "log_date" in back.columns
