"""Sinks: the prediction log (append-only, partitioned), dataset
fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_PARTITIONS = ["log_date", "endpoint"]

# The prediction-log record — metadata, the 18 request fields,
# the prediction and its bookkeeping (26 columns besides the id).
LOG_INPUTS = [("bedrooms", "int"), ("bathrooms", "double"), ("sqft_living", "int"), ("sqft_lot", "int"),
              ("floors", "double"), ("waterfront", "int"), ("view", "int"), ("condition", "int"), ("grade", "int"),
              ("sqft_above", "int"), ("sqft_basement", "int"), ("yr_built", "int"), ("yr_renovated", "int"),
              ("zipcode", "string"), ("lat", "double"), ("long", "double"), ("sqft_living15", "int"),
              ("sqft_lot15", "int")]
LOG_COLUMNS = ([("ts", "timestamp"), ("endpoint", "string"), ("model_version", "string"), ("model_type", "string"),
                ("processing_time_ms", "double")] + LOG_INPUTS
               + [("predicted_price", "double"), ("features_used", "int"), ("prediction_type", "string")])


def to_log_records(scored: DataFrame, endpoint: str, id_col: str | None = None, keep: list[str] = ()) -> DataFrame:
    """Conform scored rows to the log layout: absent inputs become NULL,
    ``prediction_type`` defaults to ``full``, numbers are cast to the log
    types (``int(float(x))`` truncation for integer fields). ``keep`` names
    columns that go along unchanged."""
    cols = scored.columns
    out = [F.col(c) for c in keep]
    out += [F.col(id_col).cast("string").alias("id")] if id_col else []
    defaults = {"ts": F.current_timestamp(), "endpoint": F.lit(endpoint), "prediction_type": F.lit("full")}
    renames = {"ts": "timestamp", "predicted_price": "prediction"}
    for name, typ in LOG_COLUMNS:
        src = name if name in cols else renames.get(name) if renames.get(name) in cols else None
        if src is not None:
            c = F.col(src)
            if typ == "int":
                c = c.cast("double").cast("int")
            out.append(F.coalesce(c.cast(typ), defaults[name]).alias(name) if name in defaults
                       else c.cast(typ).alias(name))
        else:
            out.append((defaults.get(name) if name in defaults else F.lit(None)).cast(typ).alias(name))
    return scored.select(*out)


def log_predictions(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append predictions partitioned by date and endpoint, sorted by key
    within files (min/max statistics prune key lookups). With ``batch_id``
    (streaming) the batch is written to its own ``batch_id=N`` folder with
    overwrite, so a replayed batch replaces itself instead of adding rows."""
    out = df.withColumn("log_date", F.to_date("ts"))
    sort_cols = [c for c in ("zipcode", "id") if c in df.columns]
    # rebalance: adaptive execution splits a busy (date, endpoint) over several tasks and files
    out = out.hint("rebalance", *LOG_PARTITIONS).sortWithinPartitions(*LOG_PARTITIONS, *sort_cols)
    if batch_id is None:
        out.write.mode("append").partitionBy(*LOG_PARTITIONS).parquet(path)
    else:
        out.write.mode("overwrite").partitionBy(*LOG_PARTITIONS).parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Read the log back; partition columns keep their types."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn("log_date", F.col("log_date").cast("date"))


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Dataset lineage record: row count, column count, schema text, and an
    order-free digest: the sums of both 64-bit halves of the md5 of each row's
    text. A value is its length and text, a NULL is marked, so NULL differs
    from empty text and no two rows share a text."""
    cols = cols or df.columns
    text = lambda c: F.col(c).cast("string")
    row_txt = F.concat_ws("|", *[F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-"))
                                 for c in cols])
    half = lambda at: F.sum(F.conv(F.substring("_md5", at, 16), 16, 10).cast("decimal(38,0)")).cast("string")
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.select(*cols).schema.fields)
    hashed = df.select(F.md5(row_txt).alias("_md5"))
    return hashed.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", half(1), half(17)).alias("digest")).select(
        "n_rows", F.lit(len(cols)).alias("n_cols"), "digest", F.lit(schema).alias("schema"))
