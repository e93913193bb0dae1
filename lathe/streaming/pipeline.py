"""Structured Streaming versions of scoring, logging and log analytics.

* Scoring runs the same DataFrame operators as batch scoring on the stream:
  validation is a projection, the lookup and the fitted model are static
  DataFrames joined stream-static (the lookup broadcast after its size
  check).
* Sinks are written in ``foreachBatch``: each micro-batch goes to its own
  ``batch_id=N`` folder with overwrite, so a batch replayed after a failure
  replaces its own output instead of duplicating it; the checkpoint records
  progress.
* Rolling counts use an event-time watermark and sliding windows in append
  mode: a window is emitted once the watermark passes its end; rows behind
  the watermark are dropped.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.session import new_path


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files: int | None = None) -> DataFrame:
    """Stream one driver table (a single Parquet file in ``sf_dir``)."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(sf_dir)


def run_to_completion(query_builder, timeout_s: float | None = None):
    """Start a query with ``trigger(availableNow=True)`` and wait until it has
    read everything. With ``timeout_s``, a query that is still running by then
    is stopped and ``TimeoutError`` raised: a sink in part is never an answer."""
    q = query_builder.trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream not finished after {timeout_s} s; its sink is incomplete")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def scoring_batch_writer(scored_path: str, dead_path: str, log_path: str | None = None):
    """``foreachBatch`` function: scored rows, dead letter and (optionally)
    the prediction log, each keyed by batch id (idempotent on replay)."""
    from lathe.sources.sinks import log_predictions, to_log_records

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            ok = batch.filter(F.col("error_code").isNull()).drop("error_code", "message", "details")
            bad = batch.filter(F.col("error_code").isNotNull()).drop("prediction")
            ok.write.mode("overwrite").parquet(f"{scored_path}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")
            if log_path:
                # a failing log write never fails the predictions (already written above)
                try:
                    log_predictions(to_log_records(ok, "stream"), log_path, batch_id)
                except Exception as e:  # noqa: BLE001
                    logging.getLogger(__name__).warning("prediction log write failed for batch %s: %s", batch_id, e)
        finally:
            batch.unpersist()

    return write


def log_batch_writer(log_path: str, endpoint: str | None = None, keep: list[str] = ()):
    """``foreachBatch`` function appending to the log; with ``endpoint``, the
    batch's scored rows are first made whole log records."""
    from lathe.sources.sinks import log_predictions, to_log_records

    def write(batch: DataFrame, batch_id: int) -> None:
        if endpoint:
            batch = to_log_records(batch.filter(F.col("error_code").isNull()), endpoint, keep=keep)
        log_predictions(batch, log_path, batch_id)

    return write


def rolling_counts(stream: DataFrame, ts: str = "ts", key: str = "endpoint", window: str = "1 day",
                   slide: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Sliding-window counts per key with a watermark (append mode)."""
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window, slide), key)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n"))


def stream_to_parquet(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> str:
    """Run ``df`` to completion into a Parquet sink; returns the sink path."""
    out = new_path(spark, f"{name}-out")
    chk = new_path(spark, f"{name}-chk")
    run_to_completion(df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", chk)
                      .option("path", out))
    return out


def model_batch_writer(pipeline, id_col: str, out_path: str):
    """``foreachBatch`` function scoring each micro-batch with a fitted
    pipeline whose model needs batch-only operators (the KNN join's windows
    and checkpoints); output keyed by batch id, idempotent on replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        pred = pipeline.predict(batch, id_col)
        pred.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return write
