"""Session helpers: a tuned local session for tests/bench, the shared work
folder, and a size-checked broadcast."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, app: str = "lathe", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests and bench. On a cluster, the caller's
    session (and its configuration) is used instead."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, logs, models and stream state.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset and the master is local — tests — a fresh scratch folder is created
    and registered; on a cluster a machine-local folder would not be shared,
    so an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(d)  # the setting itself cannot be changed in a running session
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared work folder."""
    import uuid

    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared work folder and read it back:
    the lineage is cut (a lost executor re-reads the table instead of
    recomputing the plan), and iterative consumers scan columnar files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000, materialize: bool = True, min_rows: int = 0,
                      what: str = "lookup") -> DataFrame:
    """Broadcast ``df`` only if it provably holds at most ``max_rows`` rows.

    The side is first materialised with ``checkpoint()`` (in the shared
    checkpoint folder), so the size check and the join read the same rows
    and a derived side (an aggregate, a fitted model) is computed once. The
    check reads at most ``max_rows + 1`` rows. Beyond the bound the frame is
    returned unhinted: the planner (and AQE at run time) uses a shuffled join.
    """
    if materialize and not df.isStreaming:
        work_dir(df.sparkSession)
        df = df.checkpoint()
    n = df.limit(max_rows + 1).count()
    if n < min_rows:
        raise ValueError(f"{what} data is empty" if min_rows == 1 else f"{what} has fewer than {min_rows} rows")
    return F.broadcast(df) if n <= max_rows else df
