"""Scans and the bindings of the logical inputs (sales, lookup, neighbour
set, prediction log) to the driver's tables.

Every binding is a lazy DataFrame: Catalyst prunes the columns and pushes
filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALES_ID = "o_orderkey"
SALES_TARGET = "price"
SALES_KEY = "c_nationkey"
SALES_FEATURES = ["n_lines", "sum_qty", "avg_disc", "avg_tax"]
LOOKUP_FEATURES = ["n_customers", "avg_acctbal", "min_acctbal", "max_acctbal"]

PART_ID = "p_partkey"
PART_TARGET = "p_retailprice"
PART_FEATURES = ["p_size", "key_mod", "name_len"]


# Natural key of each driver table: an under-split scan is spread on it.
TABLE_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey",
              "supplier": "s_suppkey", "events": "event_id", "documents": "doc_id", "pages": "page_id"}


_SCANS: dict = {}


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """One lazily planned scan per (session, path): the Parquet footer read
    that infers the schema happens once, and later plans reuse the relation."""
    key = (spark.sparkContext.applicationId, id(spark._jsparkSession), path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def read_table(spark: SparkSession, sf_dir: str, name: str, balance: bool | None = None) -> DataFrame:
    """Scan a driver table.

    When the scan yields fewer input splits than the cluster has cores (a
    single-row-group file, say), it is hash-partitioned on the table's key to
    ``spark.sql.shuffle.partitions`` so narrow work runs in parallel and later
    aggregations/joins on that key reuse the partitioning. A well-split input
    (the large-scale case) is returned as scanned. Filters and column pruning
    still reach the Parquet scan.
    """
    df = _scan(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    key = TABLE_KEYS.get(name)
    return spread(df, key) if balance and key else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when it has fewer partitions than the
    cluster has cores; otherwise return it unchanged. For pipelines with
    heavy per-row work (rule validation, scoring) over an under-split input.

    The spread rows are persisted (memory, spilling to disk): without that
    barrier Catalyst would push the validation filter back below the
    repartition, into the single scan task. Identical plans share the cached
    rows, so repeated uses in a session read them once.
    """
    from pyspark import StorageLevel

    spark = df.sparkSession
    if df.isStreaming or df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key).persist(
        StorageLevel.MEMORY_AND_DISK)


def scan_select(spark: SparkSession, path: str, columns: list[str] | None = None, fmt: str = "parquet",
                schema: T.StructType | None = None) -> DataFrame:
    """Scan ``path`` and return ``columns`` in the requested order.

    Raises ``ValueError`` listing every requested column the source lacks.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = reader.load(path)
    if columns is None:
        return df
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"Missing columns in data: {absent}")
    return df.select(*columns)


def scan_typed_key(spark: SparkSession, path: str, columns: list[str], key: str) -> DataFrame:
    """Scan keeping the source's column order and read ``key`` as text."""
    df = spark.read.parquet(path)
    keep = [c for c in df.columns if c in set(columns)]
    return df.select(*[F.col(c).cast("string").alias(c) if c == key else F.col(c) for c in keep])


def scan_head(df: DataFrame, order_by: list[str], n: int | None = None) -> DataFrame:
    """First ``n`` rows in an explicit order (all rows when ``n`` is None).
    Spark plans ``orderBy + limit`` as a top-k (TakeOrderedAndProject)."""
    out = df.orderBy(*order_by)
    return out.limit(n) if n is not None else out


def sales_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales records: id ``o_orderkey``, target ``price`` (o_totalprice),
    key ``c_nationkey``, features from the order's lines.

    Lines are pre-aggregated per order before the join (map-side partial
    aggregation), so the join moves one row per order. Orders without lines
    keep NULL features.
    """
    li = read_table(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        (F.avg("l_discount") + F.lit(0.0)).alias("avg_disc"),
        (F.avg("l_tax") + F.lit(0.0)).alias("avg_tax"),
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias(SALES_TARGET), "o_orderpriority", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .join(cust, orders.o_custkey == cust.c_custkey, "inner")
            .select(SALES_ID, SALES_TARGET, SALES_KEY, "c_mktsegment", "o_orderpriority", "o_orderdate",
                    *SALES_FEATURES))


def lookup_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-key lookup table (per-nation customer statistics), the role of the
    demographics file: one row per key."""
    cust = read_table(spark, sf_dir, "customer")
    return cust.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_customers"),
        F.avg("c_acctbal").alias("avg_acctbal"),
        F.min("c_acctbal").alias("min_acctbal"),
        F.max("c_acctbal").alias("max_acctbal"),
    )


def parts_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour-regression set: id ``p_partkey``, target ``p_retailprice``,
    three numeric features."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        PART_ID,
        PART_TARGET,
        F.col("p_size").cast("double").alias("p_size"),
        (F.col("p_partkey") % 97).cast("double").alias("key_mod"),
        F.length("p_name").cast("double").alias("name_len"),
    )


def prediction_log_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-log records: ``events`` seen as served predictions
    (endpoint = event_type, predicted_price = value). ``ts`` is moved from
    TIMESTAMP_NTZ to TIMESTAMP (UTC session zone) so watermarks accept it."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"),
        F.col("user_id"),
        F.col("value").alias("predicted_price"),
        F.col("props"),
    )
