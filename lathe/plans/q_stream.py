"""Streaming queries, each run to completion (availableNow) and read back;
compared with the batch oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import validate as V
from lathe.plans import sqlparts as S
from lathe.plans.q_scoring import (_OUT, _score_sql, log_sql, read_back, score_frame, score_served,
                                    served_requests)
from lathe.plans.registry import register, rounded
from lathe.session import new_path
from lathe.streaming.pipeline import (log_batch_writer, model_batch_writer, rolling_counts, run_to_completion,
                                      scoring_batch_writer, stream_to_parquet, table_stream)

IDS = S.REQUEST_IDS


def _scored_stream(spark, sf):
    li = table_stream(spark, sf, "lineitem")
    req = li.selectExpr(*IDS, *[f"{e} AS `{a}`" for e, a in S.REQUEST_FIELDS])
    return score_frame(req, spark, sf, V.full_request_rules())


def _run_scoring(spark, sf):
    scored, dead = new_path(spark, "stream-scored"), new_path(spark, "stream-dead")
    chk = new_path(spark, "stream-score-chk")
    run_to_completion(_scored_stream(spark, sf).writeStream.foreachBatch(scoring_batch_writer(scored, dead))
                      .option("checkpointLocation", chk))
    return scored, dead


@register("stream_score", f"{_score_sql()} SELECT {_OUT}, 'full' AS prediction_type FROM res WHERE error_code IS NULL")
def q_stream_score(spark, sf):
    scored, _ = _run_scoring(spark, sf)
    out = spark.read.parquet(scored).drop("timestamp", "batch_id")
    return rounded(out, 6)


@register("stream_dead_letter", f"{_score_sql()} SELECT {', '.join(IDS)}, zipcode, error_code FROM res "
                                "WHERE error_code IS NOT NULL")
def q_stream_dead_letter(spark, sf):
    _, dead = _run_scoring(spark, sf)
    return spark.read.parquet(dead).select(*IDS, "zipcode", "error_code")


@register("stream_log", log_sql())
def q_stream_log(spark, sf):
    """Requests arrive as a stream, are scored and logged as whole records."""
    scored = score_served(served_requests(table_stream(spark, sf, "lineitem")), spark, sf)
    path, chk = new_path(spark, "stream-log"), new_path(spark, "stream-log-chk")
    run_to_completion(scored.writeStream.foreachBatch(log_batch_writer(path, "predict", IDS)).option("checkpointLocation", chk))
    return read_back(spark.read.option("basePath", path).parquet(path))


@register("stream_rolling_counts", """WITH e AS (SELECT ts, event_type AS endpoint, date_trunc('hour', ts) AS h FROM events),
w AS (SELECT h - (INTERVAL 1 HOUR) * k AS window_start, endpoint FROM e, range(24) t(k)),
c AS (SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, endpoint, count(*) AS n FROM w GROUP BY 1, 2, 3)
SELECT * FROM c WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_rolling_counts(spark, sf):
    ev = table_stream(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"),
                                                  F.col("event_type").alias("endpoint"))
    out = stream_to_parquet(spark, rolling_counts(ev), "rolling")
    back = spark.read.parquet(out)
    return back.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"), "endpoint", "n")


def _knn_oracle():
    from lathe.plans.q_knn import _knn_sql

    return _knn_sql(5, 2, "uniform")


@register("stream_knn_score", _knn_oracle())
def q_stream_knn_score(spark, sf):
    """Parts arrive as a stream; test rows (a stream-static semi join with the
    batch split) are scored by the fitted scaler → KNN pipeline inside
    ``foreachBatch``."""
    from lathe.operators.pipeline import RegressionPipeline
    from lathe.plans.q_knn import split_parts
    from lathe.sources.tables import PART_FEATURES, PART_ID, PART_TARGET

    s = split_parts(spark, sf)
    pipe = RegressionPipeline(PART_FEATURES, PART_TARGET, "robust", None, "knn", {"n_neighbors": 5}).fit(
        s.filter("split = 'train'"), PART_ID)
    test_ids = s.filter("split = 'test'").select(PART_ID)
    stream = table_stream(spark, sf, "part").select(
        PART_ID, F.col("p_size").cast("double").alias("p_size"),
        (F.col("p_partkey") % 97).cast("double").alias("key_mod"), F.length("p_name").cast("double").alias("name_len"))
    stream = stream.join(test_ids, PART_ID, "left_semi")
    out, chk = new_path(spark, "stream-knn"), new_path(spark, "stream-knn-chk")
    run_to_completion(stream.writeStream.foreachBatch(model_batch_writer(pipe, PART_ID, out))
                      .option("checkpointLocation", chk))
    back = spark.read.parquet(out)
    return rounded(back.select(F.col(PART_ID).alias("qid"), "prediction"), 4)
